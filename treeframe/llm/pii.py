"""Personal data: fixed patterns as seeds, and identifiers found by their context.

Base spans come from four patterns and their checks. They seed a bootstrapped
extraction, all in DataFrame functions:

1. Mentions: base spans, and other words that look like identifiers (with a
   digit or @), each with its lexical patterns, the two words of the text before it and the
   two after. Words with a digit or @ are all one word in a pattern, and a pattern of
   nothing else does not count.
2. The graph of patterns and instances is scored in rounds. A pattern is trusted if at
   least ``SUPPORT`` distinct instances stand in it that are seeds or were found in the
   rounds before; its confidence is the mean score of all its distinct instances, seeds being 1. An
   instance's score is the chance that not all of its trusted patterns are wrong, and
   it is found if that reaches ``CONFIDENCE``. So what one frame gives away makes the
   next frame known.
3. Found instances are added as spans of kind ``context`` in all places where they stand.

Patterns use possessive and anchored repetition, so long runs of one kind of
character take linear time. Mentions are written once; what is shuffled is
mentions, never texts. Counts per pattern and instance are combined before each
shuffle.

Defined results: a null text counts as empty and has no spans; rows that repeat
an id are rows of their own; an empty table gives an empty one. Offsets are in code points,
ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeframe.functions.arrays import let, running
from treeframe.llm.rows import saved, small, text_of

# Kinds in order, and what each looks like.
KINDS = ("email", "ip", "card", "phone", "context")
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
IP_PARTS = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"
# A word with a digit or @, from its start to its last letter or digit.
_SPACE = r"\x20\x09-\x0D"
IDENTIFIER = (
    rf"(?<![^{_SPACE}])(?=[^0-9@{_SPACE}]*+[0-9@])[^{_SPACE}]{{5,}}[A-Za-z0-9]"
)

CONTEXT = 64  # characters on each side in which the words of a pattern are looked for
SUPPORT, CONFIDENCE, ROUNDS = 3, 0.8, 4


def _found(text: Column, pattern: str, maybe: Column) -> Column:
    """Matches in order, as (start, end, value, before, after).

    ``before`` and ``after`` are the ``CONTEXT`` characters of the text on each
    side, other matches included.
    """

    def placed(found: Column) -> Column:
        return running(
            F.zip_with(
                found["hit"], F.slice(found["gap"], 1, F.size(found["hit"])),
                lambda hit, gap: F.struct(hit.alias("hit"), gap.alias("gap")),
            ),
            F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("value"),
                     F.lit("").alias("before")),
            lambda last, item: let(
                last["end"] + F.char_length(item["gap"]),
                lambda start: F.struct(
                    start.alias("start"),
                    (start + F.char_length(item["hit"])).alias("end"),
                    item["hit"].alias("value"),
                    F.right(
                        F.concat(last["before"], last["value"], F.right(item["gap"], F.lit(CONTEXT))),
                        F.lit(CONTEXT),
                    ).alias("before"),
                ),
            ),
        )

    def with_after(found: Column) -> Column:
        def piece(part: str, i: Column) -> Column:
            return F.left(F.coalesce(F.get(found[part], i), F.lit("")), F.lit(CONTEXT))

        # Two more matches hold two words at least.
        return F.transform(
            placed(found),
            lambda span, i: span.withField("after", F.left(
                F.concat(piece("gap", i + 1), piece("hit", i + 1), piece("gap", i + 2),
                         piece("hit", i + 2), piece("gap", i + 3)),
                F.lit(CONTEXT),
            )),
        )

    matches = let(
        F.struct(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
            F.split(text, pattern, -1).alias("gap"),
        ),
        with_after,
    )
    return F.when(maybe, matches).otherwise(
        F.array().cast("array<struct<start:int,end:int,value:string,before:string,after:string>>")
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _two_words(context: Column, last: bool) -> Column:
    """The two words next to a mention, in lower case; null if there are fewer, or if both
    look like identifiers.

    A word that the end of the context cuts is none.
    """
    words = F.filter(F.split(F.lower(context), rf"[{_SPACE}]+"), lambda w: w != "")

    def pair(words: Column) -> Column:
        cut = F.when(F.char_length(context) < CONTEXT, 0).otherwise(1)
        whole = F.size(words) - cut
        two = F.slice(words, -2, 2) if last else F.slice(words, 1, 2)
        named = F.transform(two, lambda w: F.when(w.rlike("[0-9@]"), "#").otherwise(w))
        return F.when((whole >= 2) & F.exists(named, lambda w: w != "#"), F.array_join(named, " "))

    return let(words, pair)


def _mentions(spans: Column, kind: int | None) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(kind).cast("int").alias("kind"), s["end"].alias("end"),
            F.xxhash64(s["value"]).alias("instance"),
            F.concat(F.lit("< "), _two_words(s["before"], True)).alias("before"),
            F.concat(F.lit("> "), _two_words(s["after"], False)).alias("after"),
        ),
    )


def find_mentions(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: row, doc_id, base (checked spans in order), others (possible identifiers)."""
    body = text_of(text)
    digit = body.rlike("[0-9]")
    base = F.concat(
        _mentions(_found(body, EMAIL, F.contains(body, F.lit("@"))), 0),
        _mentions(
            F.filter(_found(body, IP, digit), lambda s: s["value"].rlike(IP_PARTS)), 1
        ),
        _mentions(
            F.filter(
                _found(body, CARD, digit),
                lambda s: F.char_length(_digits(s["value"])).between(12, 19)
                & F.call_function("luhn_check", _digits(s["value"])),
            ), 2,
        ),
        _mentions(
            F.filter(
                _found(body, PHONE, F.contains(body, F.lit("+"))),
                lambda s: F.char_length(_digits(s["value"])).between(9, 15),
            ), 3,
        ),
    )
    others = _mentions(_found(body, IDENTIFIER, digit | F.contains(body, F.lit("@"))), None)
    found = docs.select(
        F.col(id).alias("doc_id"), F.array_sort(base).alias("base"), others.alias("others")
    )
    apart = F.filter(
        "others",
        lambda o: ~F.exists("base", lambda b: (b["start"] < o["end"]) & (o["start"] < b["end"])),
    )
    return saved(
        found.withColumns({"row": F.monotonically_increasing_id(), "others": apart}),
        "pii-mentions",
    )


def score_instances(
    mentions: DataFrame, support: int = SUPPORT, rounds: int = ROUNDS,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """Instances in trusted patterns after the rounds, seeds left out: instance, score."""
    each = mentions.select(F.explode(F.concat("base", "others")).alias("m")).select(
        "m.instance", F.col("m.kind").isNotNull().alias("seed"),
        F.explode(F.array("m.before", "m.after")).alias("pattern"),
    )
    edges = saved(
        each.filter("pattern is not null").groupBy("pattern", "instance")
        .agg(F.max("seed").alias("seed")),
        "pii-edges",
    )
    # A seed anywhere is a seed in all patterns.
    seeds = saved(
        edges.filter("seed").select("instance", F.lit(1.0).alias("score")).distinct(), "pii-seeds"
    )
    found = seeds.limit(0)
    for _ in range(rounds):
        scores = seeds.unionByName(found)
        trusted = saved(
            edges.join(small(saved(scores, "pii-scores")), "instance", "left").groupBy("pattern")
            .agg(F.avg(F.coalesce("score", F.lit(0.0))).alias("confidence"),
                 F.count_if(F.col("score") >= confidence).alias("support"))
            .filter(F.col("support") >= support).select("pattern", "confidence"),
            "pii-patterns",
        )
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))
        found = saved(
            edges.join(small(trusted), "pattern").groupBy("instance")
            .agg((1 - doubt).alias("score")).join(small(seeds), "instance", "left_anti"),
            "pii-instances",
        )
    return found


def personal_data(
    docs: DataFrame, id: str = "doc_id", text: str = "text", confidence: float = CONFIDENCE
) -> DataFrame:
    """Per row: doc_id, base and spans, arrays of (start, kind, end) in order.

    ``kind`` is a position in ``KINDS``.
    """
    mentions = find_mentions(docs, id, text)
    scored = score_instances(mentions, confidence=confidence)
    good = saved(scored.filter(F.col("score") >= confidence).select("instance"), "pii-found")
    added = (
        mentions.select("row", F.explode("others").alias("m"))
        .select("row", "m.start", "m.end", "m.instance")
        .join(small(good), "instance").groupBy("row")
        .agg(F.collect_set(F.struct("start", F.lit(len(KINDS) - 1).alias("kind"), "end"))
             .alias("added"))
    )
    plain = F.transform(
        "base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"),
                                   s["end"].alias("end")),
    )
    spans = F.array_sort(F.concat(plain, F.coalesce(
        "added", F.array().cast("array<struct<start:int,kind:int,end:int>>"))))
    joined = mentions.join(small(saved(added, "pii-added"), 100_000), "row", "left")
    return joined.select("doc_id", plain.alias("base"), spans.alias("spans"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
