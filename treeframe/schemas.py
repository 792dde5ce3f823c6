"""Explicit schemas of the relations the package passes around."""

from __future__ import annotations

from pyspark.sql import types as T

NODE = T.StructType([
    T.StructField("ord", T.IntegerType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("node_type", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("is_leaf", T.BooleanType()),
])

FILES = T.StructType([
    T.StructField("file_id", T.LongType()),
    T.StructField("path", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("encoding", T.StringType()),
    T.StructField("read_error", T.StringType()),
])

LANGUAGES = T.StructType([
    T.StructField("registry_pos", T.IntegerType()),
    T.StructField("language", T.StringType()),
    T.StructField("extensions", T.ArrayType(T.StringType())),
    T.StructField("include_types", T.ArrayType(T.StringType())),
    T.StructField("exclude_types", T.ArrayType(T.StringType())),
    T.StructField("producer", T.StringType()),
])

# The type of a produced node before order and leaf flags are known.
ENTRY_DDL = "struct<depth:int,node_type:string,text:string>"
TREE_DDL = "array<struct<ord:int,depth:int,node_type:string,text:string,is_leaf:boolean>>"
METADATA_DDL = "struct<parser:string,node_count:bigint,parser_version:string>"
