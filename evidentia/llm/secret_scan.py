"""Secret scans with multipart credential linking, in DataFrame functions only.

Spans are code-point ranges of matches in whole texts. Strong spans stand alone: assign (a keyword, an operator and a
value of 12 characters), access (AKIA and 14 more) and hex (16 hexadecimal digits). Weak candidates are worth nothing
alone: access identifiers (ident: 16 to 40 capitals and digits with both), secrets (key: 32 characters or more
of the base-64 alphabet with a digit, a capital and a small letter) and endpoints (host: a URL's or address's
place). A weak candidate is reported when parts of both other roles, weak or strong, start within SCOPE characters of it.
The strong parts are access as identifier, and assign and hex as secret.

The interval join keeps, for each document, role and bin of SCOPE characters, only the first and last start, and looks at a
part's own bin and the two beside it; that is exact, and a text with many parts makes no pairs of parts.

Null and empty texts have no spans. Repeated rows of a document each get their own result; a null id is allowed. An empty
table gives no rows. Further columns are ignored by the query and kept by redact().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.quality_rules import let
from evidentia.plans.workspace import Workspace

# Patterns that results must agree with.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}

#: Weak candidates, by role.
IDENT = r"(?<![A-Za-z0-9+/])(?=[0-9]*[A-Z])(?=[A-Z]*[0-9])[A-Z0-9]{16,40}(?![A-Za-z0-9+/=])"
KEY = r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])[A-Za-z0-9+/]{32,}={0,2}(?![A-Za-z0-9+/=])"
HOST = r"https?://[A-Za-z0-9.-]+(?::[0-9]{1,5})?|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]{1,5})?(?![0-9.])"
#: Kinds in the order of ties, and each one's role.
KINDS = ("assign", "access", "hex", "ident", "key", "host")
ROLES = {"assign": "secret", "access": "ident", "hex": "secret", "ident": "ident", "key": "secret", "host": "host"}
#: Characters between starts of parts that belong together.
SCOPE = 256
MASK = "[SECRET]"


def running(values: Column, step) -> Column:
    """step (sum or maximum, 0 the neutral element) of each of values (array<int>) with all before it.

    An array grows by copying, so values are taken in blocks of about sqrt(n): each block by itself, then the blocks' ends.
    """
    zero = lambda: F.struct(F.lit(0).alias("now"), F.array().cast("array<int>").alias("out"))

    def grow(a: Column, x: Column) -> Column:
        now = step(a["now"], x).cast("int")
        return F.struct(now.alias("now"), F.concat(a["out"], F.array(now)).alias("out"))

    def blocks(size: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(values), size)
        own = F.transform(starts, lambda at: F.aggregate(F.slice(values, at, size), zero(), grow))
        return let(own, lambda o: let(F.aggregate(F.transform(o, lambda x: x["now"]), zero(), grow, lambda a: a["out"]), lambda ends: F.flatten(F.transform(o, lambda x, i: F.transform(x["out"], lambda v: F.when(i > 0, step(F.get(ends, i - 1), v)).otherwise(v).cast("int"))))))

    return F.when(F.size(values) > 0, let(F.ceil(F.sqrt(F.size(values))).cast("int"), blocks)).otherwise(F.array().cast("array<int>"))


def total(a: Column, b: Column) -> Column:
    return a + b


def matches(text: Column, pattern: str, may: str) -> Column:
    """array<struct<s,e,m>> of the pattern's leftmost matches; texts in which `may` isn't found are not scanned.

    The pieces between matches and the matches take turns, so that running lengths give places.
    """

    def places(pieces: Column, found: Column) -> Column:
        steps = F.transform(found, lambda m, i: (F.length(F.get(pieces, i)) + F.length(m)).cast("int"))
        ends = lambda e: F.transform(found, lambda m, i: F.struct((F.get(e, i) - F.length(m)).cast("int").alias("s"), F.get(e, i).alias("e"), m.alias("m")))
        return let(steps, lambda n: let(running(n, total), ends))

    found = let(F.split(text, pattern, -1), lambda p: let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: places(p, m)))
    return F.when(text.rlike(may), found).otherwise(F.array().cast("array<struct<s:int,e:int,m:string>>"))


def _kind(found: Column, kind: str) -> Column:
    return F.transform(found, lambda x: F.struct(x["s"].alias("s"), F.lit(KINDS.index(kind)).alias("k"), x["e"].alias("e")))


def parts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """row (a struct of columns keep) with base and weak: arrays of (s, k, e), k the place in KINDS."""
    text = F.coalesce(F.col("text"), F.lit(""))
    assign = F.filter(matches(text, ASSIGN, r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= LEAST["assign"])
    access = matches(text, r"AKIA[A-Z0-9]{14,}", r"AKIA[A-Z0-9]{14}")  # a shorter run holds no longer match, so none is lost
    hexes = matches(text, r"[0-9a-f]{16,}", r"[0-9a-f]{16}")
    weak = [_kind(matches(text, p, m), k) for k, p, m in (("ident", IDENT, r"[A-Z0-9]{16}"), ("key", KEY, r"[A-Za-z0-9+/]{32}"), ("host", HOST, r"https?://[A-Za-z0-9.-]|[0-9]\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]"))]
    return docs.select(F.struct(*keep).alias("row"), F.concat(_kind(assign, "assign"), _kind(access, "access"), _kind(hexes, "hex")).alias("base"), F.concat(*weak).alias("weak"))


def linked(found: DataFrame) -> DataFrame:
    """row_id and added (array of (s, k, e)): the weak parts of found (row_id, base, weak) that complementary parts stand near."""
    role = F.element_at(F.create_map(*(F.lit(x) for i, k in enumerate(KINDS) for x in (i, ROLES[k]))), F.col("p.k"))
    each = found.filter(F.size("weak") > 0).select("row_id", F.explode(F.concat("base", "weak")).alias("p"), F.lit(SCOPE).alias("w"))
    each = each.select("row_id", "p", role.alias("role"), F.floor(F.col("p.s") / F.col("w")).cast("int").alias("bin"))
    ends = each.groupBy("row_id", "bin", "role").agg(F.min("p.s").alias("first"), F.max("p.s").alias("last"))
    near = ends.select("row_id", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("bin"), F.col("role").alias("of"), F.array("first", "last").alias("at"))
    roles = ("ident", "secret", "host")
    near = near.groupBy("row_id", "bin").agg(*(F.flatten(F.collect_list(F.when(F.col("of") == r, F.col("at")))).alias(f"near_{r}") for r in roles))
    has = lambda r: F.exists(f"near_{r}", lambda s: F.abs(s - F.col("p.s")) <= SCOPE)
    others = F.lit(True)
    for r in roles:
        others = others & ((F.col("role") == r) | has(r))
    weak = each.filter(F.col("p.k") >= 3).join(near, ["row_id", "bin"])
    return weak.filter(others).groupBy("row_id").agg(F.collect_set("p").alias("added"))


def said(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"], x["e"])), ",")


def scan(docs: DataFrame, keep: list[str]) -> DataFrame:
    """row (a struct of columns keep) with base and spans, arrays of (s, k, e); only rows with weak parts are joined."""
    work = Workspace(docs.sparkSession, "secrets")
    found = work.table("parts", parts(docs, keep).withColumn("row_id", F.monotonically_increasing_id()))
    joined = found.filter(F.size("weak") > 0).join(linked(found), "row_id", "left")
    joined = joined.select("row", "base", F.array_distinct(F.concat("base", F.coalesce("added", F.array().cast("array<struct<s:int,k:int,e:int>>")))).alias("spans"))
    return found.filter(F.size("weak") == 0).select("row", "base", F.col("base").alias("spans")).unionAll(joined)


def query(docs: DataFrame) -> DataFrame:
    """op10: every document's secrets."""
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == KINDS.index(k))).cast("bigint").alias(f"n_{k}")
    return scan(docs, ["doc_id"]).select("row.doc_id", count("assign"), count("access"), count("hex"), F.sha2(said(F.col("base")), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """text with every span, overlapping ones as one, replaced by MASK. What stays is cut from four-byte letters, whose places need no search."""

    def gaps(raw: Column, sorted_spans: Column, past: Column) -> Column:
        fresh = lambda x, i: (i == 0) | (x["s"] >= F.get(past, i - 1))
        before = F.transform(sorted_spans, lambda x, i: F.when(fresh(x, i), F.struct(F.when(i == 0, 0).otherwise(F.get(past, i - 1)).alias("a"), x["s"].alias("b"))))
        cut = lambda a, n: F.decode(F.substring(raw, 4 * a + 1, 4 * n), "UTF-32")
        kept = F.transform(F.filter(before, lambda g: g.isNotNull()), lambda g: cut(g["a"], g["b"] - g["a"]))
        return F.array_join(F.concat(kept, F.array(cut(F.element_at(past, -1), F.length(raw)))), MASK)

    ends = lambda x: running(F.transform(x, lambda p: p["e"]), F.greatest)
    return let(F.encode(text, "UTF-32"), lambda raw: let(F.array_sort(spans), lambda x: let(ends(x), lambda past: gaps(raw, x, past))))


def redact(docs: DataFrame) -> DataFrame:
    """docs, all columns, with secrets masked in text and n_chars set anew where the text changed."""
    hit = F.size("spans") > 0
    changed = {"text": masked(F.col("row.text"), F.col("spans"))}
    changed["n_chars"] = F.length(changed["text"]).cast("bigint")
    own = lambda c: F.when(hit, changed[c]).otherwise(F.col(f"row.`{c}`")) if c in changed else F.col(f"row.`{c}`")
    return scan(docs, docs.columns).select(*(own(c).alias(c) for c in docs.columns))


ORACLE = None
