"""Node producers: what turns a file's content into a tree.

A native producer is a column expression. A Python producer runs a user's
per-file parser inside Spark's tasks, in Arrow batches.
"""

from __future__ import annotations

import multiprocessing
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from treeframe.functions import trees as T

Entry = tuple[int, str, str | None]

# Fixed value: the text put before a parser's own error.
PARSE_ERROR = "Failed to parse: "


@dataclass(frozen=True)
class NativeProducer:
    """``build`` maps the content column to a tree column."""

    name: str
    build: Callable[[Column], Column]
    version: str = "1"


@dataclass(frozen=True)
class PandasProducer:
    """``make`` is called once per task and gives ``parse(content, language)``.

    ``parse`` yields ``(depth, node type, leaf text)`` in visit order, from the
    root at depth 0. What it raises becomes that file's error. With a ``deadline``, in
    seconds for a file, parsing is done in a child process of the task: a parser that
    hangs, or that ends the process as faults of native code do, costs its file alone.
    """

    name: str
    make: Callable[[], Callable[[str, str], Iterable[Entry]]]
    version: str = "1"
    deadline: float | None = None


def pandas_producer(
    name: str, parse: Callable[[str, str], Iterable[Entry]], version: str = "1",
    deadline: float | None = None,
) -> PandasProducer:
    """A Python producer from a plain function."""
    return PandasProducer(name, lambda: parse, version, deadline)


MARKUP_PRODUCER = NativeProducer("markup", T.markup_tree)
PROSE_PRODUCER = NativeProducer("prose", T.prose_tree)
OUTLINE_PRODUCER = NativeProducer("outline", T.outline_tree)


Producer = NativeProducer | PandasProducer

# What a choice that cannot be met is answered with.
UNKNOWN_PARSER = "Parser '{}' not found"
UNKNOWN_DEFAULT = "Parser '{}' not registered"
NO_DEFAULT = "No default parser set"


@dataclass(frozen=True)
class Producers:
    """The producers a parse may use, in order, and which one is used unasked.

    A value: ``with_producer`` and ``by_default`` give changed copies, so a
    plan keeps the producers that it was made with.
    """

    items: tuple[Producer, ...] = ()
    default: str = ""

    def with_producer(self, *more: Producer) -> Producers:
        """A copy with these added; of equal names the later one counts."""
        by_name = {p.name: p for p in (*self.items, *more)}
        return replace(self, items=tuple(by_name.values()))

    def by_default(self, name: str) -> Producers:
        if name not in self.names():
            raise ValueError(UNKNOWN_DEFAULT.format(name))
        return replace(self, default=name)

    def choose(self, name: str | None = None) -> Producer:
        """The producer of this name, or the default one."""
        wanted = name or self.default
        found = [p for p in self.items if p.name == wanted]
        if not found:
            raise ValueError(UNKNOWN_PARSER.format(wanted) if wanted else NO_DEFAULT)
        return found[0]

    def names(self) -> list[str]:
        return [p.name for p in self.items]

    def of_kind(self, kind: type) -> list[Producer]:
        return [p for p in self.items if isinstance(p, kind)]


def default_producers() -> Producers:
    return Producers((MARKUP_PRODUCER, PROSE_PRODUCER, OUTLINE_PRODUCER), MARKUP_PRODUCER.name)


def walk_nodes(root: Any, source: bytes) -> Iterator[Entry]:
    """Entries of a syntax tree object with ``type``, ``children`` and byte offsets.

    Keeps its own stack, so no tree is too deep.
    """
    stack = [(root, 0)]
    while stack:
        node, depth = stack.pop()
        children = node.children
        text = None
        if not children:
            text = source[node.start_byte:node.end_byte].decode("utf-8", "replace")
        yield depth, node.type, text
        stack.extend((child, depth + 1) for child in reversed(children))


def _checked(entries: Iterable[Entry]) -> tuple[list[int], list[str], list[str | None]]:
    depths: list[int] = []
    types: list[str] = []
    texts: list[str | None] = []
    for depth, node_type, text in entries:
        fits = 0 < depth <= depths[-1] + 1 if depths else depth == 0
        if not fits:
            raise ValueError(f"node {len(depths)} has depth {depth}")
        depths.append(depth)
        types.append(node_type)
        texts.append(text)
    if not depths:
        raise ValueError("no nodes")
    return depths, types, texts


class Guard:
    """A parser in a child process, which is started again after a file that hangs or ends it."""

    def __init__(self, make: Callable[[], Callable[[str, str], Iterable[Entry]]], deadline: float):
        self.make, self.deadline, self.child, self.pipe = make, deadline, None, None

    def __call__(self, content: str, language: str) -> Iterable[Entry]:
        if self.child is None:
            context = multiprocessing.get_context("fork")
            self.pipe, end = context.Pipe()
            self.child = context.Process(target=_serve, args=(self.make, end, self.pipe), daemon=True)
            self.child.start()
            end.close()
            self._answer()  # that the parser is made
        try:
            self.pipe.send((content, language))
        except OSError:
            pass  # the child has ended; the answer says so
        return zip(*self._answer())

    def _answer(self):
        try:
            if not self.pipe.poll(self.deadline):
                raise TimeoutError(f"parser took longer than {self.deadline:g} s")
            ok, value = self.pipe.recv()
        except (EOFError, OSError) as problem:
            late = isinstance(problem, TimeoutError)
            code = None if late else self._ended()
            self.close()
            raise problem if late else RuntimeError(f"parser process ended ({code})") from None
        if not ok:
            raise ValueError(value)
        return value

    def _ended(self) -> int | None:
        self.child.join(1)
        return self.child.exitcode

    def close(self) -> None:
        if self.child is not None:
            self.child.kill()
            self.child.join()
            self.pipe.close()
            self.child = None


def _serve(make, pipe, other_end) -> None:
    """Parse what comes through the pipe until it closes."""
    other_end.close()
    parse = None
    try:
        while True:
            try:
                if parse is None:
                    parse = make()
                    answer = True, None
                else:
                    answer = True, _checked(parse(*pipe.recv()))
            except EOFError:
                return
            except Exception as problem:  # any parser failure is that file's result
                answer = False, str(problem)
            pipe.send(answer)
            if parse is None:
                return
    except OSError:
        return


ENTRIES_DDL = "struct<depths:array<int>,types:array<string>,texts:array<string>,error:string>"


def python_entries(producers: Iterable[PandasProducer]) -> Callable[[Column], Column]:
    """A column function from ``struct<producer, content, language>`` to parsed entries.

    A NULL stays NULL and is not parsed, so files of all kinds of producer go
    through one plan.
    """
    makers = {
        p.name: p.make if p.deadline is None else (lambda p=p: Guard(p.make, p.deadline))
        for p in producers
    }

    @F.pandas_udf(ENTRIES_DDL)
    def parse(asked: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready: dict[str, Callable[[str, str], Iterable[Entry]]] = {}

        def one(name: str | None, content: str, language: str) -> tuple:
            if name is None:
                return None, None, None, None
            try:
                if name not in ready:
                    ready[name] = makers[name]()
                return *_checked(ready[name](content, language)), None
            except Exception as problem:  # any parser failure is that file's result
                return None, None, None, f"{PARSE_ERROR}{problem}"

        try:
            for batch in asked:
                rows = [one(*row) for row in zip(batch["producer"], batch["content"], batch["language"])]
                yield pd.DataFrame(
                    {
                        name: pd.Series([row[i] for row in rows], dtype=object)
                        for i, name in enumerate(("depths", "types", "texts", "error"))
                    }
                )
        finally:
            for parser in ready.values():
                if isinstance(parser, Guard):
                    parser.close()

    return parse


def entries_tree(entries: Column) -> Column:
    """The tree of parsed entries; NULL where there are none."""
    zipped = F.arrays_zip(
        entries["depths"].alias("depth"), entries["types"].alias("node_type"),
        entries["texts"].alias("text"),
    )
    return T.finish(
        F.transform(zipped, lambda z: F.struct(*[z[f].alias(f) for f in ("depth", "node_type", "text")]))
    )
