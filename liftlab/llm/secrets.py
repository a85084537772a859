"""Secret scan with corpus-wide ownership frequency, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftlab.session import written

# The patterns of the three base kinds. Matches of ASSIGN are taken first and dropped by
# the length of their value afterwards, as a dropped match still hides what it overlaps.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "owned")

#: A bare word that looks like a key: 20 or more characters with two digits, a letter of each case.
BARE = (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9][A-Za-z+/_-]*[0-9])(?=[A-Z0-9+/_-]*[a-z])"
        r"(?=[a-z0-9+/_-]*[A-Z])[A-Za-z0-9+/_-]{20,}")
#: What every text with a candidate matches.
HINT = (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}|"
        r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20}")
#: A value held by more owners, or in more repositories of however few owners, is a widely copied example.
MOST_OWNERS = 2
MOST_REPOSITORIES = 20
#: Elements that a running sum walks over at a time; what is longer is cut, and the sums of the parts are walked over.
WALK = 256
#: Code points of the blocks that a text is cut into before spans are taken out of it.
TEXT_BLOCK = 4096


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, add: Callable[[Column, Column], Column], levels: int = 2) -> Column:
    """What ``add`` makes of each number and all before it, for arrays of up to ``WALK`` to the power of ``levels`` + 1.

    A walk that appends to an array copies it at every step, so only short parts are walked over.
    """
    def walk(a: Column) -> Column:
        start = F.struct(F.lit(None).cast("int").alias("last"), F.array().cast("array<int>").alias("out"))

        def step(state: Column, x: Column) -> Column:
            now = F.when(state["last"].isNull(), x).otherwise(add(state["last"], x))
            return F.struct(now.alias("last"), F.concat(state["out"], F.array(now)).alias("out"))

        return F.aggregate(a, start, step)["out"]

    def cut(a: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.call_function("div", F.size(a) - 1, F.lit(WALK)).cast("int")),
                            lambda k: walk(F.slice(a, k * WALK + 1, WALK)))
        return _let(parts, lambda p: _let(
            _running(F.transform(p, lambda x: F.element_at(x, -1)), add, levels - 1),
            lambda ends: F.flatten(F.transform(p, lambda x, k: F.when(k == 0, x).otherwise(
                F.transform(x, lambda y: add(F.get(ends, k - 1), y)))))))

    if not levels:
        return walk(values)
    return _let(values, lambda a: F.when(F.size(a) <= WALK, walk(a)).otherwise(cut(a)))


def _matches(text: Column, pattern: str, kind: int, value: Column | None = None) -> Column:
    """All leftmost matches as (start, kind, end, value); places come from the pieces between them."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    zipped = F.arrays_zip(pieces.alias("piece"), whole.alias("match"),
                          (whole if value is None else value).alias("value"))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")

    def placed(rows: Column) -> Column:
        ends = _running(F.transform(rows, lambda x: F.length(x["piece"]) + F.length(x["match"])), lambda x, y: x + y)
        return F.zip_with(rows, ends, lambda x, end: F.struct(
            (end - F.length(x["match"])).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["value"].alias("value")))

    # the piece after the last match has none
    return F.when(F.size(whole) > 0, _let(F.filter(zipped, lambda x: x["match"].isNotNull()), placed)).otherwise(empty)


def candidates(text: Column) -> Column:
    """All base matches, and the bare key-like words that overlap none, by start and kind."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assign = F.filter(_matches(text, ASSIGN, 0, values), lambda m: F.length(m["value"]) >= ASSIGN_LEAST)
    return F.concat(assign, _matches(text, ACCESS, 1), _matches(text, HEX, 2), _matches(text, BARE, 3))


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """(row, spans) of the rows that hold a candidate, written once; ``row`` packs all columns.

    Each span has start, kind, end (code points, end exclusive) and live: whether its value is held
    by at most ``MOST_OWNERS`` owners and in at most ``MOST_REPOSITORIES`` repositories. Values travel as SHA-256 hashes. They are counted per
    (value, owner, repository), then per (value, owner), then per value, so a value that a third of
    all rows hold is summed before each shuffle. A null owner or repository counts as one of its own.
    """
    hinted = docs.filter(F.col("text").rlike(HINT))
    found = hinted.select(F.struct(*docs.columns).alias("row"), candidates(F.col("text")).alias("all"))
    base = F.filter("all", lambda m: m["kind"] < 3)
    bare = F.filter("all", lambda m: (m["kind"] == 3) & ~F.exists(
        "base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    hashed = F.transform(F.array_sort(F.concat("base", "bare")), lambda m: F.struct(
        m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end"),
        F.sha2(m["value"], 256).alias("value")))
    found = found.withColumn("base", base).withColumn("bare", bare).select("row", hashed.alias("spans")) \
        .filter(F.size("spans") > 0).withColumn("n", F.monotonically_increasing_id())
    found = written(found, "secrets")
    each = found.select("n", F.col("row")[owner].alias("owner"), F.col("row")[repository].alias("repository"),
                        F.explode("spans").alias("span"))
    owners = ownership(each.select("span.value", "owner", "repository"))
    judged = each.join(owners, F.col("span.value") == owners["value"]).select(
        "n", F.struct("span.start", "span.kind", "span.end", 
                      ((F.col("owners") <= MOST_OWNERS) & (F.col("repositories") <= MOST_REPOSITORIES)).alias("live"),
                      "owners", "repositories").alias("span"))
    return found.select("n", "row").join(
        judged.groupBy("n").agg(F.array_sort(F.collect_list("span")).alias("spans")), "n").drop("n")


def ownership(values: DataFrame) -> DataFrame:
    """(value, owners, repositories): how many distinct owners and (owner, repository) hold each value."""
    held = values.groupBy("value", "owner", "repository").agg(F.lit(1).alias("one"))
    by_owner = held.groupBy("value", "owner").agg(F.sum("one").alias("repositories"))
    return by_owner.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """One row per document: counts and digest of its base spans, all spans, and what ownership says.

    All base spans are listed. A bare key-like word is added as ``owned`` if it is owner-specific.
    ``n_live`` counts listed spans whose value few owners hold in few repositories, ``n_copied`` the widely copied
    examples; ``owners`` and ``repositories`` list how many hold the value of each listed span. Null and empty texts hold no span. Repeated rows give repeated rows, and a null
    doc_id stays null. An empty table gives no rows.
    """
    spans = F.col("spans")
    kept = F.filter(spans, lambda s: (s["kind"] < 3) | s["live"])
    base = F.filter(spans, lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    none = F.array().cast("array<struct<start:int,kind:int,end:int,live:boolean,owners:long,repositories:long>>")
    held = scan(docs, owner, repository).select("row.doc_id", "spans")
    free = _free(docs, owner, repository).select("doc_id", none.alias("spans"))
    return held.unionByName(free).select(
        "doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(kept).alias("spans"),
        F.size(F.filter(kept, lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter(kept, lambda s: ~s["live"])).cast("long").alias("n_copied"),
        *[F.array_join(F.transform(kept, lambda s: s[c].cast("string")), ",").alias(c) for c in ("owners", "repositories")])


def _free(docs: DataFrame, owner: str, repository: str) -> DataFrame:
    """The rows without any candidate."""
    return docs.filter(~F.coalesce(
        F.col("text").rlike(HINT) & (F.size(candidates(F.col("text"))) > 0), F.lit(False)))


def redact(docs: DataFrame, mask: str = "<secret>", owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """``docs`` with all rows and columns; owner-specific secrets become ``mask``, copied examples stay.

    Spans that overlap are masked as one. ``n_chars`` follows the new text if it is there.
    """
    text = F.col("row.text")

    def taken(blocks: Column, start: Column, length: Column) -> Column:
        first = F.call_function("div", start, F.lit(TEXT_BLOCK)).cast("int")
        last = F.call_function("div", start + length, F.lit(TEXT_BLOCK)).cast("int")
        near = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
        return F.substr(near, start - first * TEXT_BLOCK + 1, length)

    def masked(blocks: Column) -> Column:
        def with_ends(ends: Column) -> Column:
            def piece(s: Column, i: Column) -> Column:
                before = F.coalesce(F.get(ends, i - 1), F.lit(0))
                gap = s["start"] - before
                return F.when(gap < 0, "").otherwise(F.concat(taken(blocks, before, F.greatest(gap, F.lit(0))), F.lit(mask)))

            last = F.coalesce(F.element_at(ends, -1), F.lit(0))
            return F.concat(F.array_join(F.transform(live, piece), ""), taken(blocks, last, F.length(text) - last))

        # where the spans up to each one end
        return F.when(F.size(live) == 0, text).otherwise(
            _let(_running(F.transform(live, lambda s: s["end"]), lambda x, y: F.greatest(x, y)), with_ends))

    live = F.filter("spans", lambda s: s["live"])
    new = _let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_BLOCK}}}"), F.lit(0)), masked)
    held = scan(docs, owner, repository).select("row", new.alias("text"))
    changed = {"text": F.col("text")} | ({"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
                                         if "n_chars" in docs.columns else {})
    return held.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns]).unionByName(
        _free(docs, owner, repository))
