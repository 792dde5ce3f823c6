"""Trees as array columns.

A tree is one ``array<struct<ord, depth, node_type, text, is_leaf>>`` per file, in
visit order; everything here maps one row to one row, inside the JVM, so a
whole pipeline from text to outline runs without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from treeframe import schemas
from treeframe.functions.arrays import let, run_lengths, running
from treeframe.functions.text import leaf_literal, unquote_literal

_NO_LIMIT = 2_000_000_000

# Markup tags that never enclose other nodes here, because they
# are empty by definition or their end tag is optional and often missing.
FLAT_TAGS = (
    "area", "b", "base", "br", "col", "embed", "hr", "img", "input", "link",
    "meta", "p", "source", "track", "wbr",
)

# One pass over the text: comments, elements whose content is not markup (whole),
# tags, text runs. All of the text is in some token. What is not closed ends with the
# text, so that no opening is searched to the end in vain. A tag may hold ``>`` in a
# quoted value; a quote that is not closed before the next tag stands for itself.
_VALUES = r"(?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+"
# Elements that hold text alone. If there is a < in it, the opening tag and the text up to
# their closing tag are one token.
_TEXT_ONLY = r"(?i:textarea|title)"
_TEXT_OPENING = rf"<{_TEXT_ONLY}(?![A-Za-z0-9]){_VALUES}>"
TOKEN = (
    r"(?s)<!--.*?(?:-->|\z)"
    rf"|<(?i:script)\b{_VALUES}>.*?(?:</(?i:script)[ \t\r\n]*>|\z)"
    rf"|<(?i:style)\b{_VALUES}>.*?(?:</(?i:style)[ \t\r\n]*>|\z)"
    rf"|<({_TEXT_ONLY})(?![A-Za-z0-9]){_VALUES}(?<!/)>[^<]*+(?:(?!</(?i:\1)[ \t\r\n/>])<[^<]*+)++"
    rf"|<[/!?]?[A-Za-z]{_VALUES}>"
    r"|<?[^<]+"
    r"|<"
)
# The tag of text that may look like markup.
RAW_TEXT = "#"
TAG_NAME = r"^</?([A-Za-z][A-Za-z0-9]*)"
# What an opening tag closes if it is open, unless one of the elements
# named second is open inside it.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table", "thead", "tbody", "tfoot")),
    "thead": (("thead", "tbody", "tfoot"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "option": (("option",), ("select", "optgroup", "datalist")),
}
# Bytes that the names of the open elements take, a few hundred levels; what would be
# deeper encloses nothing. It keeps what a node knows of the nodes above it short in a
# page that closes nothing.
DEEPEST = 2048
SENTENCE = r"[^.!?]+[.!?]*|[.!?]+"
_VISIBLE = r"[^ \t\r\n\f]"


def _entry(depth: Column | int, node_type: Column | str, text: Column) -> Column:
    depth = F.lit(depth) if isinstance(depth, int) else depth
    node_type = F.lit(node_type) if isinstance(node_type, str) else node_type
    return F.struct(
        depth.cast("int").alias("depth"), node_type.alias("node_type"), text.alias("text")
    )


def finish(entries: Column) -> Column:
    """Number produced entries and mark the leaves; only leaves keep their text."""

    def numbered(e: Column) -> Column:
        def node(x: Column, i: Column) -> Column:
            leaf = F.coalesce(F.get(e, i + 1)["depth"], F.lit(-1)) <= x["depth"]
            return F.struct(
                i.alias("ord"),
                x["depth"].alias("depth"),
                x["node_type"].alias("node_type"),
                F.when(leaf, x["text"]).alias("text"),
                leaf.alias("is_leaf"),
            )

        return F.transform(e, node)

    return let(entries, numbered)


# --- producers -------------------------------------------------------------


def markup_tokens(content: Column) -> Column:
    """Tags and text runs, each with its tag name, direction and weight."""

    def one(t: Column) -> Column:
        tag = F.when(t.startswith("<"), F.lower(F.regexp_extract(t, TAG_NAME, 1))).otherwise(F.lit(""))
        return F.struct(t.alias("source"), tag.alias("tag"))

    def opening(t: Column) -> Column:
        return F.when(
            t.startswith("<t") | t.startswith("<T"),
            F.regexp_extract(t, rf"^({_TEXT_OPENING})(?s:.)", 1),
        ).otherwise("")

    def both(t: Column) -> Column:
        def parts(o: Column) -> Column:
            text = F.substring(t, F.length(o) + 1, F.lit(_NO_LIMIT))
            return F.when(o != "", F.array(
                one(o), F.struct(text.alias("source"), F.lit(RAW_TEXT).alias("tag"))
            )).otherwise(F.array(one(t)))

        return let(opening(t), parts)

    raw = F.filter(
        F.regexp_extract_all(content, F.lit(TOKEN), F.lit(0)),
        lambda t: F.when(t.startswith("<"), ~t.startswith("<!--"))
        .otherwise(t.rlike(_VISIBLE)),
    )
    named = let(
        raw,
        lambda found: F.when(
            F.exists(found, lambda t: opening(t) != ""), F.flatten(F.transform(found, both))
        ).otherwise(F.transform(found, one)),
    )
    return F.transform(
        named,
        lambda t: F.struct(
            t["source"].alias("source"),
            t["tag"].alias("tag"),
            F.concat(t["tag"], F.lit("/")).alias("key"),
            ((t["tag"] != "") & t["source"].startswith("</")).alias("closing"),
            F.when((t["tag"] == "") | t["tag"].isin(RAW_TEXT, *FLAT_TAGS), 0)
            .when(t["source"].startswith("</"), -1)
            .when(t["source"].endswith("/>") | t["tag"].isin("script", "style"), 0)
            .otherwise(1).alias("weight"),
        ),
    )


def no_open() -> Column:
    """State of :func:`after_token` before the first token."""
    return F.lit("")


def open_count(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


# From the innermost element to the first that closes, over none that keeps it open.
_CLOSE_PATTERNS = {
    name: rf"^(?:(?!(?:{'|'.join(unless)})/)[^/]++/)*?(?:{'|'.join(ends)})/"
    for name, (ends, unless) in CLOSES.items()
}


def _from(path: Column, place: Column) -> Column:
    """The path without the element that begins at ``place`` and all inside it."""
    inner = F.substring(path, place, F.lit(_NO_LIMIT))
    return F.substring(inner, F.locate("/", inner) + 1, F.lit(_NO_LIMIT))


def after_token(path: Column, token: Column) -> Column:
    """Open elements after a token, innermost first, each name with a slash.

    A closing tag closes the innermost element of its name with all inside it,
    or nothing; some opening tags close what they cannot be in.
    """
    tag, key = token["tag"], token["key"]
    own = F.call_function("locate", F.concat(F.lit("/"), key), F.concat(F.lit("/"), path))
    closed = (
        F.when(path.startswith(key), F.substring(path, F.length(key) + 1, F.lit(_NO_LIMIT)))
        .when(own > 0, _from(path, own)).otherwise(path)
    )
    # A pattern by tag keeps the plan short: one look-up for all of them.
    pattern = F.try_element_at(
        F.create_map(*[F.lit(x) for item in _CLOSE_PATTERNS.items() for x in item]), tag
    )
    around = F.coalesce(F.regexp_replace(path, pattern, F.lit("")), path)
    opened = F.when(F.octet_length(path) < DEEPEST, F.concat(key, around)).otherwise(around)
    return F.when(token["weight"] == 0, path).when(token["closing"], closed).otherwise(opened)


def markup_tree(content: Column) -> Column:
    """Markup text to a tree; broken markup still gives a tree.

    The root is ``document``; each opening tag is a node, each text run a
    ``text`` leaf, and a script or style element one leaf. Flat tags enclose
    nothing, and a closing tag without an opening one is passed over.
    """

    def entry(token: Column, path: Column, level: Column) -> Column:
        inside = F.when(token["weight"] == 0, 1).when(path.startswith(token["key"]), 0).otherwise(1)
        return _entry(
            level + inside,
            F.when(token["tag"] == RAW_TEXT, F.lit("text"))
            .when(token["source"].startswith("<!"), F.lit("declaration"))
            .when(token["tag"] == "", F.lit("text")).otherwise(token["tag"]),
            token["source"],
        )

    def entries(tokens: Column) -> Column:
        # Only tags that open or close something change what is open; what stands between two
        # of them has the level of the first.
        changing = F.filter(
            F.transform(tokens, lambda t, i: F.struct(t.alias("token"), i.alias("at"))),
            lambda z: z["token"]["weight"] != 0,
        )

        def parts(found: Column) -> Column:
            paths = running(F.transform(found, lambda z: z["token"]), no_open(), after_token)
            starts = F.concat(
                F.array(F.struct(F.lit(0).alias("at"), F.lit("").alias("path"))),
                F.zip_with(found, paths, lambda z, path: F.struct(z["at"].alias("at"), path.alias("path"))),
            )

            def part(known: Column) -> Column:
                def nodes(start: Column, k: Column) -> Column:
                    stop = F.coalesce(F.get(known, k + 1)["at"], F.size(tokens))
                    return let(open_count(start["path"]), lambda level: F.transform(
                        F.filter(
                            F.slice(tokens, start["at"] + 1, stop - start["at"]), lambda t: ~t["closing"]
                        ),
                        lambda t: entry(t, start["path"], level),
                    ))

                return F.flatten(F.transform(known, nodes))

            return let(starts, part)

        return F.concat(F.array(_entry(0, "document", F.lit(""))), let(changing, parts))

    return finish(let(markup_tokens(content), entries))


def outline_tree(outline: Column) -> Column:
    """Outline text back to a tree; the inverse of :func:`render`."""

    # A leaf line is ``type: literal``; the type itself may hold a colon.
    split = F.transform(
        F.filter(F.split(outline, "\n"), lambda l: l.rlike(_VISIBLE)),
        lambda l: F.struct(
            l.alias("line"), F.ltrim(l).alias("body"),
            F.regexp_extract(l, r"^ *(.+?): ['\"]", 1).alias("leaf"),
        ),
    )
    return finish(
        F.transform(
            split,
            lambda x: _entry(
                F.floor((F.length(x["line"]) - F.length(x["body"])) / 2),
                F.when(x["leaf"] != "", x["leaf"]).otherwise(x["body"]),
                F.when(
                    x["leaf"] != "",
                    unquote_literal(F.substring(x["body"], F.length(x["leaf"]) + 3, _NO_LIMIT)),
                ),
            ),
        )
    )


def prose_tree(text: Column) -> Column:
    """Plain text to a document - line - sentence tree."""

    def line_entries(line: Column) -> Column:
        sentences = F.filter(
            F.transform(
                F.regexp_extract_all(line, F.lit(SENTENCE), F.lit(0)), lambda s: F.trim(s)
            ),
            lambda s: s != "",
        )
        return F.concat(
            F.array(_entry(1, "line", line)),
            F.transform(sentences, lambda s: _entry(2, "sentence", s)),
        )

    return finish(
        F.concat(
            F.array(_entry(0, "document", F.lit(""))),
            F.flatten(F.transform(F.split(text, "\n"), line_entries)),
        )
    )


# --- ancestors -------------------------------------------------------------


def with_paths(tree: Column) -> Column:
    """Add ``parent_ord``, ``path_types`` and ``path_ords`` (root first) to each node.

    Holds for any depth.
    """

    def joined(nodes: Column) -> Column:
        # State: positions of the open nodes, from the root down to this node. They
        # differ from ords once a tree is pruned.
        chains = running(
            F.transform(
                nodes, lambda n, i: F.struct(n["depth"].alias("depth"), i.alias("at"))
            ),
            F.expr("cast(array() as array<int>)"),
            lambda chain, n: F.array_append(F.slice(chain, F.lit(1), n["depth"]), n["at"]),
        )

        def node(chain: Column, n: Column) -> Column:
            above = F.slice(chain, F.lit(1), F.size(chain) - 1)
            return F.struct(
                *[n[f].alias(f) for f in schemas.NODE.fieldNames()],
                F.get(nodes, F.get(chain, F.size(chain) - 2))["ord"].alias("parent_ord"),
                F.transform(above, lambda at: F.get(nodes, at)["node_type"]).alias("path_types"),
                F.transform(above, lambda at: F.get(nodes, at)["ord"]).alias("path_ords"),
            )

        return let(
            chains,
            lambda found: F.transform(nodes, lambda n, i: node(F.get(found, i), n)),
        )

    return let(tree, joined)


_OPEN_DDL = "array<struct<ord:int,depth:int,node_type:string>>"


def _no_open() -> Column:
    return F.expr(f"cast(array() as {_OPEN_DDL})")


def _opened(chain: Column, node: Column) -> Column:
    """The open nodes after ``node``: those above it, and itself."""
    return F.array_append(
        F.filter(chain, lambda c: c["depth"] < node["depth"]),
        F.struct(*[node[f].alias(f) for f in ("ord", "depth", "node_type")]),
    )


def open_at_end(tree: Column) -> Column:
    """Nodes of a part of a tree that are still open where the part ends."""
    return F.aggregate(tree, _no_open(), _opened)


def open_at_starts(parts: Column) -> Column:
    """For each part, in order, the nodes of earlier parts that are open where it starts.

    ``parts`` is ``array<struct<part, low, tail>>`` with each part's least depth and
    its :func:`open_at_end`.
    """

    def starts(ps: Column) -> Column:
        after = running(
            ps,
            _no_open(),
            lambda chain, p: F.concat(
                F.filter(chain, lambda c: c["depth"] < p["low"]), p["tail"]
            ),
        )
        return let(
            after,
            lambda ends: F.transform(
                ps,
                lambda p, i: F.struct(
                    p["part"].alias("part"),
                    F.coalesce(F.get(ends, i - 1), _no_open()).alias("start"),
                ),
            ),
        )

    return let(parts, starts)


def with_paths_after(tree: Column, start: Column) -> Column:
    """:func:`with_paths` for a part of a tree, given the nodes open where it starts."""

    def joined(nodes: Column) -> Column:
        chains = running(nodes, start, _opened)

        def node(above: Column, n: Column) -> Column:
            return F.struct(
                *[n[f].alias(f) for f in schemas.NODE.fieldNames()],
                F.get(above, F.size(above) - 1)["ord"].alias("parent_ord"),
                F.transform(above, lambda c: c["node_type"]).alias("path_types"),
                F.transform(above, lambda c: c["ord"]).alias("path_ords"),
            )

        return let(
            chains,
            lambda found: F.transform(
                nodes,
                lambda n, i: let(
                    F.slice(F.get(found, i), F.lit(1), F.size(F.get(found, i)) - 1),
                    lambda above: node(above, n),
                ),
            ),
        )

    return let(tree, joined)


# --- pruning ---------------------------------------------------------------


def _as_types(types: Column | Iterable[str] | None) -> Column:
    if isinstance(types, Column):
        return types
    if types is None:
        return F.lit(None).cast("array<string>")
    return F.array(*[F.lit(t) for t in types]).cast("array<string>")


def prune(
    tree: Column,
    include: Column | Iterable[str] | None = None,
    exclude: Column | Iterable[str] | None = None,
) -> Column:
    """Nodes an outline shows.

    With an include list a node is shown when all its ancestors are listed; its
    own type does not matter, so the root always stays. Without one, an exclude
    list hides everything below a listed node. An empty list counts as none.
    """
    inc, exc = _as_types(include), _as_types(exclude)

    def shown(nodes: Column) -> Column:
        opens = (
            lambda t: F.when(F.size(inc) > 0, F.array_contains(inc, t))
            .when(F.size(exc) > 0, ~F.array_contains(exc, t))
            .otherwise(F.lit(True))
        )
        # State: the depth below which nodes are hidden at this point.
        limits = running(
            F.transform(
                nodes,
                lambda n: F.struct(
                    n["depth"].alias("depth"), opens(n["node_type"]).alias("opens")
                ),
            ),
            F.lit(_NO_LIMIT),
            lambda limit, n: F.when(
                n["depth"] <= limit,
                F.when(n["opens"], F.lit(_NO_LIMIT)).otherwise(n["depth"]),
            ).otherwise(limit),
        )
        pairs = F.filter(
            F.arrays_zip(nodes.alias("node"), limits.alias("limit")),
            lambda z: z["node"]["depth"] <= z["limit"],
        )
        return F.transform(pairs, lambda z: z["node"])

    return let(tree, shown)


# --- rendering -------------------------------------------------------------


def outline_line(node: Column) -> Column:
    indent = F.repeat(F.lit("  "), node["depth"])
    return F.when(
        node["is_leaf"],
        F.concat(indent, node["node_type"], F.lit(": "),
                 leaf_literal(F.coalesce(node["text"], F.lit("")))),
    ).otherwise(F.concat(indent, node["node_type"]))


def render(tree: Column) -> Column:
    """Outline text: one line per node, two spaces per level, quoted leaf text."""
    return F.array_join(F.transform(tree, outline_line), "\n")


def render_types(tree: Column) -> Column:
    """Outline of node types only."""
    return F.array_join(
        F.transform(tree, lambda n: F.concat(F.repeat(F.lit("  "), n["depth"]), n["node_type"])),
        "\n",
    )


# --- subtrees --------------------------------------------------------------


def subtree_hashes(tree: Column) -> Column:
    """For each node a 64-bit hash of its subtree: types, leaf texts and their order.

    One walk from the last node to the first: what a node needs of its children is
    their running hash, kept for each level. An empty leaf text counts as none.
    """

    def hashed(nodes: Column) -> Column:
        own = F.transform(
            F.reverse(nodes),
            lambda n: F.struct(
                n["depth"].alias("depth"),
                F.xxhash64(n["node_type"], F.coalesce(n["text"], F.lit(""))).alias("own"),
            ),
        )
        none = F.lit(0).cast("bigint")

        def after(state: Column, n: Column) -> Column:
            levels, depth = state["levels"], n["depth"]
            missing = F.greatest(depth - F.size(levels), F.lit(0))
            # All that is deeper, as outlines may skip levels.
            whole = F.xxhash64(n["own"], F.slice(levels, depth + 2, F.lit(_NO_LIMIT)))
            return let(whole, lambda h: F.struct(
                F.concat(
                    F.slice(levels, F.lit(1), depth), F.array_repeat(none, missing),
                    F.array(F.xxhash64(F.coalesce(F.get(levels, depth), none), h)),
                ).alias("levels"),
                h.alias("hash"),
            ))

        start = F.struct(F.array().cast("array<bigint>").alias("levels"), none.alias("hash"))
        return F.reverse(F.transform(running(own, start, after), lambda s: s["hash"]))

    return let(tree, hashed)


def placed_subtrees(tree: Column) -> Column:
    """``array<struct<place, node_type, hash>>``: each node's path of types and subtree."""
    return F.transform(
        F.arrays_zip(with_paths(tree).alias("node"), subtree_hashes(tree).alias("hash")),
        lambda z: F.struct(
            F.array_join(z["node"]["path_types"], "/").alias("place"),
            z["node"]["node_type"].alias("node_type"), z["hash"].alias("hash"),
        ),
    )


# --- measures and searches -------------------------------------------------


def type_counts(tree: Column) -> Column:
    """Nodes per type, as ``array<struct<value, n>>``."""
    return run_lengths(F.transform(tree, lambda n: n["node_type"]))


def contains_type(tree: Column, node_type: str) -> Column:
    return F.exists(tree, lambda n: n["node_type"] == node_type)


def max_depth(tree: Column) -> Column:
    return F.array_max(F.transform(tree, lambda n: n["depth"]))


def mean_depth(tree: Column) -> Column:
    total = F.aggregate(tree, F.lit(0).cast("bigint"), lambda s, n: s + n["depth"])
    return total / F.size(tree)


def enclosing(tree: Column, types: Iterable[str]) -> Column:
    """For each node, how many of its ancestors are of the given types."""
    wanted = [F.lit(t) for t in types]

    def counts(nodes: Column) -> Column:
        # State: for each open level, the listed nodes from the root down to it.
        chains = running(
            nodes,
            F.expr("cast(array() as array<int>)"),
            lambda chain, n: let(
                F.slice(chain, F.lit(1), n["depth"]),
                lambda above: F.array_append(
                    above,
                    F.coalesce(F.get(above, F.size(above) - 1), F.lit(0))
                    + F.array_contains(F.array(*wanted), n["node_type"]).cast("int"),
                ),
            ),
        )
        return F.transform(
            chains, lambda chain: F.coalesce(F.get(chain, F.size(chain) - 2), F.lit(0))
        )

    return let(tree, counts)


def placed(nodes: Column, *types: str) -> Column:
    """Nodes of the given types with their positions, as ``array<struct<node, at>>``."""
    return F.filter(
        F.transform(nodes, lambda n, i: F.struct(n.alias("node"), i.alias("at"))),
        lambda p: p["node"]["node_type"].isin(*types),
    )


def first_after(nodes: Column, at: Column, node_type: str, within: int) -> Column:
    """Text of the first node of a type among the ``within`` ones after a position."""
    near = F.filter(F.slice(nodes, at + 2, within), lambda x: x["node_type"] == node_type)
    return F.get(near, F.lit(0))["text"]


def names(tree: Column, decl_type: str, name_type: str, within: int = 4) -> Column:
    """Declarations with the first name among the next ``within`` nodes.

    Gives ``array<struct<decl_ord, name>>``; a declaration without a name in
    reach is left out.
    """

    def found(nodes: Column) -> Column:
        decls = F.transform(
            placed(nodes, decl_type),
            lambda p: F.struct(
                p["node"]["ord"].alias("decl_ord"),
                first_after(nodes, p["at"], name_type, within).alias("name"),
            ),
        )
        return F.filter(decls, lambda d: d["name"].isNotNull())

    return let(tree, found)
