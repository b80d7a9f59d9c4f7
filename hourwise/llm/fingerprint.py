"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in DataFrame operations only.

A text's distinct paragraph digests are put into a sketch of three tables of ``TABLE`` cells: each digest falls into
one cell a table, a cell holds a count and the exclusive or of its digests and of their check hashes. Only cells in use are
written. The sketches of two versions subtract cell by cell; a cell that holds one
digest (count 1 or -1 and a matching check hash) gives it away, it is taken out of its other cells,
and so on, the three tables in turn: peeling recovers the digests that differ. Where cells remain after ``ROUNDS`` rounds,
the pair is tried again with tables four times as large, until every pair is decoded. A pair whose number of digests lets expect more
differences than the first tables decode begins with larger ones.

likeness = shared / all distinct digests = (a + b - d) / (a + b + d), with d recovered digests; two texts without paragraphs are alike (1).

A paragraph ends at a line break, and inside a long line at a sentence end chosen by
its content (the character before the stop), so an edit changes only the paragraphs it touches. Of a paragraph of more than
``HEAD`` words the first ``HEAD`` are one digest (of the text's first paragraph, ``FIRST`` words, so that short texts have
several digests too), the rest is cut after words chosen by their hash, one in ``CUT``. In scripts
written without spaces each character counts as a word. The edited text keeps the paragraphs that end before the edit;
only what follows them is cut and hashed again.
Null and empty texts have no paragraphs. Rows are in ascending (doc_id, text hash) order, null ids last; repeated rows follow one
another; after the last row comes the first. Only id and text are read.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

TABLE = 32
#: Steps of peeling, each over one of the three tables.
ROUNDS = 12
LEVELS = 12
#: Place of the number of recovered digests among the cells of a pair.
COUNT = -1
BREAK = r"[\n\r]+|(?<=[a-eA-E0-9][.!?])[ \t]+"
#: Between words, and after each character of a script without spaces.
WORD = (r"(?<=[\s\p{Z}\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}])"
        r"(?=[^\s\p{Z}])")
HEAD = 24
FIRST = 6
CUT = 16
#: Rows in a bucket of neighbouring documents, about, and buckets, at most.
BUCKET_ROWS = 512
MOST_BUCKETS = 1 << 14


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pieces(paragraph: Column, head: Column) -> Column:
    """A paragraph's parts: itself, if it has at most ``head`` words. Cuts depend on what stands before them alone."""
    words = F.split(paragraph, WORD)
    marked = F.transform(words, lambda w, i: F.when(
        (i == head - 1) | (i >= head) & (F.pmod(F.xxhash64(F.trim(w)), F.lit(CUT)) == 0), F.concat(w, F.lit("\n"))).otherwise(w))
    return F.when(F.char_length(paragraph) <= head, F.array(paragraph)).otherwise(F.split(F.array_join(marked, ""), "\n"))


def paragraph_digests(text: Column, starts: Column) -> Column:
    """For each paragraph the 64-bit digests of its parts, in order. ``starts``: the first one is the first of a document."""
    def of(paragraph: Column, i: Column) -> Column:
        cut = let(F.when((i == 0) & starts, F.lit(FIRST)).otherwise(F.lit(HEAD)), lambda head: pieces(F.trim(paragraph), head))
        parts = F.filter(F.transform(cut, lambda x: F.trim(x)), lambda x: x != "")
        return F.transform(parts, lambda x: F.xxhash64(x))
    return F.transform(F.split(text, BREAK), of)


def distinct(by_paragraph: Column) -> Column:
    return F.array_distinct(F.flatten(by_paragraph))


def edited_digests(text: Column, by_paragraph: Column, following: Column) -> Column:
    """Distinct digests of the edited text: those of the paragraphs that end before the edit, and of all that follows them cut anew."""
    q = quarter(text)

    def kept_and_new(lines: Column) -> Column:
        rest = F.concat(F.element_at(lines, -1), F.substring(following, F.lit(1), q))
        return let(F.size(lines) - 1, lambda whole: distinct(F.concat(
            F.slice(by_paragraph, F.lit(1), whole), paragraph_digests(rest, whole == 0))))
    return let(F.split(F.substring(text, F.lit(1), F.char_length(text) - q), BREAK), kept_and_new)


def cell(digest: Column, table: int, size: int, level: int) -> Column:
    return (F.pmod(F.xxhash64(digest, F.lit(level * 8 + table)), F.lit(size)) + table * size).cast("long")


def check_of(digest: Column) -> Column:
    return F.xxhash64(F.lit("check"), digest)


def with_neighbour(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, by_paragraph (digests), next_text, next_d (distinct digests). Neighbours are found within buckets of the id order; the first row of the next
    bucket is added at the end of each."""
    base = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    base = base.withColumn("h", F.xxhash64("text"))
    n = docs.count()
    buckets = max(1, min(MOST_BUCKETS, -(-n // BUCKET_ROWS)))
    # borders of the buckets: approximate quantiles, at most MOST_BUCKETS numbers
    borders: list[int] = []
    if buckets > 1:
        shares = F.array(*[F.lit(k / buckets) for k in range(1, buckets)])
        found = docs.agg(F.percentile_approx(id_col, shares, F.lit(4 * buckets)).alias("b")).first()["b"]
        borders = sorted(set(found or []))
    steps = len(borders).bit_length()
    if borders:
        padded = F.from_json(F.lit(str(borders + [(1 << 63) - 1] * ((1 << steps) - len(borders)))), "array<bigint>")
        # binary search: the number of borders that are not above the id
        place = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(0), lambda low, k: F.when(
            F.get(padded, low + F.get(F.array(*[F.lit(1 << s) for s in range(steps)]), F.lit(steps) - k) - 1) <= F.col("doc_id"),
            low + F.get(F.array(*[F.lit(1 << s) for s in range(steps)]), F.lit(steps) - k)).otherwise(low))
    else:
        place = F.lit(0)
    # null ids: last, dealt out by the text's hash
    base = base.withColumn("bucket", F.when(F.col("doc_id").isNotNull(), place)
                           .otherwise(F.lit(MOST_BUCKETS + 32) + F.shiftright("h", 58)).cast("int"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("h").asc()]
    firsts = materialize(base.groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h")).alias("x"))
                         .select("bucket", "x.doc_id", "x.h"), "fp-firsts")  # a row a bucket
    chain = Window.orderBy("bucket")
    whole = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nexts = firsts.select(
        F.col("bucket").alias("to"),
        F.coalesce(F.lead(F.struct("doc_id", "h")).over(chain), F.first(F.struct("doc_id", "h")).over(whole)).alias("x"))
    nexts = nexts.select("to", F.col("x.doc_id").alias("nid"), F.col("x.h").alias("nh"))
    ghosts = (base.join(F.broadcast(nexts), F.col("doc_id").eqNullSafe(F.col("nid")) & (F.col("h") == F.col("nh")))
              .dropDuplicates(["to"]).select("doc_id", "text", "h", F.col("to").alias("bucket"), F.lit(True).alias("ghost")))
    rows = base.withColumn("ghost", F.lit(False)).unionByName(ghosts).withColumn(
        "by_paragraph", paragraph_digests(F.col("text"), F.lit(True)))
    near = Window.partitionBy("bucket").orderBy(F.col("ghost"), *order)
    return (rows.withColumn("next_text", F.lead("text").over(near)).withColumn("next_d", distinct(F.lead("by_paragraph").over(near)))
            .where("not ghost").select("doc_id", "text", "by_paragraph", "next_text", "next_d"))


def quarter(text: Column) -> Column:
    return F.floor(F.char_length(text) / 4).cast("int")


def edited(text: Column, following: Column) -> Column:
    """The last quarter of the code points replaced by the first as many of the following text."""
    q = quarter(text)
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - q), F.substring(following, F.lit(1), q))


def sketch(rows: DataFrame, keys: list[str], digest: str, sign: Column, size: int, level: int) -> DataFrame:
    """Cells (keys, id, n, x, c) of the digests in each row's array, counted with ``sign``. All digests of a key are in one partition of ``rows``."""
    single = rows.select(*keys, sign.alias("s"), F.explode(digest).alias("g"))
    placed = single.select(*keys, "s", "g", F.explode(F.array(*[cell(F.col("g"), t, size, level) for t in range(3)])).alias("id"))
    return (placed.groupBy(*keys, "id").agg(F.sum("s").alias("n"), F.bit_xor("g").alias("x"),
                                            F.bit_xor(check_of(F.col("g"))).alias("c")))


def peel(cells: DataFrame, keys: list[str], size: int, level: int) -> DataFrame:
    """(keys, d, stuck): number of digests recovered from the subtracted cells, and of cells that remain. A digest lies in one cell
    of a table, so a step over one table finds it once; the number found so far is the row COUNT of its key. Grouping keeps
    the partitioning by key."""
    def row(id_: Column, n: Column, x: Column, c: Column) -> Column:
        return F.struct(id_.cast("long").alias("id"), n.cast("long").alias("n"), x.alias("x"), c.alias("c"))
    live = F.expr(f"id = {COUNT} or n != 0 or x != 0L or c != 0L")
    flow = cells.select(*keys, F.col("id").cast("long"), F.col("n").cast("long"), "x", "c").where(live)
    kept = row(*map(F.col, ("id", "n", "x", "c")))
    for step in range(ROUNDS):
        table = step % 3
        pure = ((F.col("id") >= table * size) & (F.col("id") < (table + 1) * size) & (F.abs("n") == 1)
                & (F.col("c") == check_of(F.col("x"))))
        out = [row(cell(F.col("x"), t, size, level), -F.col("n"), F.col("x"), F.col("c")) for t in range(3) if t != table]
        found = row(F.lit(COUNT), F.lit(1), F.lit(0).cast("long"), F.lit(0).cast("long"))
        moved = flow.select(*keys, F.inline(F.when(pure, F.array(found, *out)).otherwise(F.array(kept))))
        flow = moved.groupBy(*keys, "id").agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("c").alias("c")).where(live)
    counted = F.col("id") == COUNT
    return flow.groupBy(*keys).agg(F.sum(F.when(counted, F.col("n")).otherwise(0)).alias("d"),
                                   F.sum(F.when(counted, 0).otherwise(1)).alias("stuck"))


def first_level(expected: Column, size: int) -> Column:
    """The level whose tables decode ``expected`` differences: two a place of one table."""
    return F.least(F.lit(LEVELS - 1), F.greatest(F.lit(0), F.ceil(F.log(4.0, F.greatest(expected, F.lit(1)) / (2 * size))))).cast("int")


def differences(table: DataFrame, size: int = TABLE) -> DataFrame:
    """(rid, pair, d): number of differing digests of d and e (pair 0) and of d and f (pair 1), by
    subtracting and peeling, with larger tables for the pairs that fail. An edit changes about a quarter of the text, neighbours may
    differ in everything; pairs start with tables for that. ``table`` is bucketed by rid; the pairs that failed come to its rows by rid
    alone, so that the digests stay where they are, at any size."""
    starts = [first_level((F.size("d") + F.size("e")) / 4, size), first_level(F.size("d") + F.size("f"), size)]
    last = table.agg(F.max(F.greatest(*starts))).first()[0] or 0
    done, again = None, None
    for level in range(LEVELS):
        rows = table if again is None else table.join(again.hint("shuffle_hash"), "rid", "left")
        failed = [F.lit(False) if again is None else F.coalesce(F.array_contains("failed", pair), F.lit(False)) for pair in (0, 1)]
        now = rows.select("rid", F.inline(F.filter(F.array(*(
            F.struct(F.lit(pair).alias("pair"), ((starts[pair] == level) | failed[pair]).alias("now"), F.col("d").alias("a"), F.col(other).alias("b"))
            for pair, other in ((0, "e"), (1, "f")))), lambda x: x["now"])))
        both = now.select("rid", "pair", F.inline(F.array(
            F.struct(F.lit(1).alias("sign"), F.col("a").alias("digests")), F.struct(F.lit(-1).alias("sign"), F.col("b").alias("digests")))))
        cells = sketch(both, ["rid", "pair"], "digests", F.col("sign"), size, level)
        result = materialize(peel(cells, ["rid", "pair"], size, level), "fp-peeled")
        solved = result.where("stuck = 0").select("rid", "pair", "d")
        done = solved if done is None else done.unionByName(solved)
        stuck = result.where("stuck > 0")
        if level >= last and stuck.isEmpty():
            return done
        again = stuck.groupBy("rid").agg(F.collect_set("pair").alias("failed"))
        size *= 4
    raise RuntimeError(f"pairs that {LEVELS} sketches do not decode")


def sketch_text(table: DataFrame, digest: str, out: str) -> DataFrame:
    """(rid, out): the sketch as text: number of digests, then id.count.digests.checks of each cell in use, ascending."""
    cells = sketch(table.select("rid", digest), ["rid"], digest, F.lit(1), TABLE, 0)
    lines = F.array_sort(F.collect_list(F.struct("id", F.concat_ws(".", F.col("id"), F.col("n"), F.hex("x"), F.hex("c")).alias("t"))))
    return cells.groupBy("rid").agg(F.array_join(F.transform(lines, lambda r: r["t"]), ",").alias(out))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = with_neighbour(docs, id_col, text_col)
    changed = rows.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    base = materialize(changed.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), distinct(F.col("by_paragraph")).alias("d"),
        edited_digests(F.col("text"), F.col("by_paragraph"), F.col("next_text")).alias("e"), F.col("next_d").alias("f")), "fp-base")
    spark = docs.sparkSession
    # with fewer buckets than shuffle partitions a join would deal the bucketed side out again
    parts = max(-(-base.count() // 4000), int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"fp_{uuid.uuid4().hex}"
    # bucketed by row, so that the groupings and joins below shuffle no digests again
    base.repartition(parts, "rid").write.bucketBy(parts, "rid").format("parquet").saveAsTable(name)
    table = spark.table(name)
    diffs = differences(table)
    near = diffs.groupBy("rid").agg(F.max(F.when(F.col("pair") == 0, F.col("d"))).alias("d0"),
                                    F.max(F.when(F.col("pair") == 1, F.col("d"))).alias("d1"))
    sizes = table.select("rid", "doc_id", "n_chars", "edited_sha256", *(F.size(c).alias(c) for c in "def"))
    joined = (sizes.join(sketch_text(table, "d", "fd"), "rid", "left").join(sketch_text(table, "e", "fe"), "rid", "left")
              .join(near.hint("shuffle_hash"), "rid", "left"))

    def alike(other: str, d: str) -> Column:
        total, d = F.col("d") + F.col(other), F.coalesce(F.col(d), F.lit(0))
        return F.when(total == 0, F.lit(1.0)).otherwise((total - d) / (total + d))
    return joined.select(
        "doc_id", "n_chars", "edited_sha256",
        F.concat_ws(":", "d", F.coalesce("fd", F.lit(""))).alias("fingerprint"),
        F.concat_ws(":", "e", F.coalesce("fe", F.lit(""))).alias("edited_fingerprint"),
        alike("e", "d0").alias("near_edited"), alike("f", "d1").alias("near_next"))
