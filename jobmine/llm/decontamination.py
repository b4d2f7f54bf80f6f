"""Benchmark decontamination by spaced seeds (native).

Every window of ``SPAN`` words is hashed under a few fixed masks that read some of its words only,
so a substituted word under an ignored place does not hide the window. Test hashes are joined to the
hashes of all document windows; each hit names a diagonal (document position minus item position),
whose whole overlap with the item is then compared word by word, under the item's length and around
the hit.

The masks alone miss some overlaps of the required share (a copy with every fourth word replaced), so
every item is also cut into one run of words more than it may have unequal words. At least one run
of an accepted overlap is equal, so looking up the runs misses none. ``NEAR`` equal words are
looked for around windows under a mask only.

Windows are made and looked up within one stage: the test side is broadcast in blocks of a fixed
number of hashes, one pass over the documents per block, so any size of the benchmark works and only
verified hits are shuffled. Words are runs of letters and digits, A-Z lower-cased. Items shorter than
the span are found by their runs only.

Defined cases: null or empty texts are clean, null or wordless items match nothing; equal rows are
judged alike and reported once; an item that occurs several times in a document is reported with its
best place (most equal words, then the first). Other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmine.llm.common import lowered, matching, narrow, text_key, union_all
from jobmine.session import stage

SPAN = 11
# Places read by each mask, of a window of SPAN words.
MASKS = ((0, 1, 2, 4, 7, 8, 10), (0, 2, 3, 6, 7, 9, 10), (0, 1, 3, 4, 5, 8, 10))
# Words of a run that are read; a run of an item is shorter if the item's length asks for it.
RUN = 3
SHARE = 0.7
NEAR = 13
BLOCK_HASHES = 500_000
_BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def word_list(text: Column) -> Column:
    """Words of letters, digits and anything beyond ASCII; none for an empty text."""
    return F.array_remove(F.split(lowered(text), _BETWEEN), "")


def _key(words: Column, at: Column, mask: tuple[int, ...], kind: int) -> Column:
    return F.xxhash64(F.lit(kind), *[F.get(words, at + F.lit(m)) for m in mask])


def _kinds(lengths: list[int], span: int) -> list[tuple[int, int, tuple[int, ...]]]:
    """(kind, words of the window, places read) of each seed: masks first, then runs of the lengths."""
    masks = [(kind, span, mask) for kind, mask in enumerate(MASKS) if max(mask) < span]
    return masks + [(len(MASKS) + n, n, tuple(range(n))) for n in lengths]


def _hashes(rows: DataFrame, carried: list[str], lengths: list[int], span: int) -> DataFrame:
    """All windows of ``rows`` (column words): the carried columns, place, hash."""
    place = F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("place")
    places = rows.where(F.size("words") > 0).select(*carried, "words", place)
    keyed = [
        F.when(F.col("place") + n <= F.size("words"), _key(F.col("words"), F.col("place"), mask, kind))
        for kind, n, mask in _kinds(lengths, span)
    ]
    return places.select("*", F.explode(F.array(*keyed)).alias("hash")).where("hash IS NOT NULL")


def _item_runs(items: DataFrame, share: float) -> DataFrame:
    """item, words, place, n_run: disjoint runs, one more than the words of the item that may differ."""
    n = F.size("words")
    runs = n - F.greatest(F.ceil(n * share), F.lit(1)).cast("int") + 1
    cut = items.select("item", "words", n.alias("n"), runs.alias("runs")).where("runs > 0")
    cut = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("k"))
    least = F.floor(F.col("n") / F.col("runs")).cast("int")
    over = F.col("n") - least * F.col("runs")  # so many first runs have a word more
    return cut.select(
        "item", "words", (F.col("k") * least + F.least("k", over)).alias("place"),
        F.least(least + (F.col("k") < over).cast("int"), F.lit(RUN)).alias("n_run"))


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", span: int = SPAN,
                 share: float = SHARE):
    """(staged item windows, staged items, the different lengths of the runs)."""
    items = stage(benchmark.select(
        F.monotonically_increasing_id().alias("item"), benchmark[id_col].alias("item_id"),
        F.transform(word_list(F.coalesce(benchmark[text_col], F.lit(""))), lambda w: F.xxhash64(w)).alias("words"),
    ).where(F.size("words") > 0), "items")
    runs = _item_runs(items, share)
    lengths = sorted(r["n_run"] for r in runs.select("n_run").distinct().collect())  # at most RUN
    columns = ["hash", "item", "place", F.size("words").alias("n")]
    windows = _hashes(items, ["item"], [], span).select(*columns, F.lit(True).alias("masked"))
    for kind, n, mask in _kinds(lengths, span):
        if kind >= len(MASKS):
            own = runs.where(F.col("n_run") == n).withColumn("hash", _key(F.col("words"), F.col("place"), mask, kind))
            windows = windows.unionByName(own.select(*columns, F.lit(False).alias("masked")))
    return stage(windows.distinct(), "item-windows"), items, lengths


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_id_col: str = "item_id", item_text_col: str = "text", share: float = SHARE,
             span: int = SPAN, block_hashes: int = BLOCK_HASHES) -> DataFrame:
    """Verified overlaps: doc_id, text_key, item_id, position, n_equal, n_words of the item."""
    windows, items, lengths = item_windows(benchmark, item_id_col, item_text_col, span, share)
    blocks = max(1, -(-windows.count() // block_hashes))
    block = F.pmod(F.xxhash64("hash"), F.lit(blocks))
    source = narrow(docs, id_col, text_col)
    rows = source.select("doc_id", text_key(F.col("text")).alias("text_key"),
                         F.transform(word_list(F.col("text")), lambda w: F.xxhash64(w)).alias("words"))
    keyed = _hashes(rows, ["doc_id", "text_key"], lengths, span)
    found = []
    for k in range(blocks):
        part = windows.where(block == k).select(
            F.col("hash").alias("_hash"), F.col("item").alias("_item"), F.col("place").alias("_place"),
            F.col("n").alias("_n"), F.col("masked").alias("_masked"))
        hits = keyed.join(F.broadcast(part), keyed["hash"] == part["_hash"])
        start = F.col("place") - F.col("_place")
        # The words that face the item on this diagonal; an item may begin before the document.
        facing = F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("_n") + F.least(start, F.lit(0)))
        found.append(hits.select("doc_id", "text_key", "_item", "_place", "_masked", start.alias("start"),
                                 facing.alias("facing")))
    texts = items.select(F.col("item").alias("_own"), "item_id", F.col("words").alias("item_words"))
    hits = union_all(found)
    hits = hits.join(F.broadcast(texts) if blocks == 1 else texts, F.col("_item") == F.col("_own"))
    lead = F.greatest(-F.col("start"), F.lit(0))
    own = F.slice("item_words", lead + 1, F.size("item_words"))
    aligned = F.zip_with(own, "facing", lambda a, b: a.eqNullSafe(b).cast("int"))
    first = F.greatest(F.col("_place") - lead - span, F.lit(0))
    around = F.slice("aligned", first + 1, F.col("_place") - lead + 2 * span - first)

    def total(ones):
        return F.aggregate(ones, F.lit(0), lambda s, x: s + x)

    judged = hits.withColumn("aligned", aligned).select(
        "doc_id", "text_key", "item_id", "_item", "start", total(F.col("aligned")).alias("n_equal"),
        F.when(F.col("_masked"), total(around)).alias("n_near"), F.size("item_words").alias("n_words"),
    ).where((F.col("n_equal") >= F.col("n_words") * share) | F.coalesce(F.col("n_near") >= NEAR, F.lit(False)))
    best = judged.groupBy("doc_id", "text_key", "_item", "item_id", "n_words").agg(
        F.min(F.struct((-F.col("n_equal")).alias("less"), F.col("start"))).alias("b"))
    return best.select("doc_id", "text_key", "item_id", F.col("b.start").alias("position"),
                       (-F.col("b.less")).alias("n_equal"), "n_words")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The whole rows that no benchmark item contaminates."""
    return matching(docs, stage(overlaps(docs, benchmark, id_col, text_col), "overlaps"), "left_anti", id_col, text_col)


def op5(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per contaminated document and item."""
    found = overlaps(docs, benchmark)
    return found.select("doc_id", "item_id", "position", "n_equal", "n_words",
                        F.round(F.col("n_equal") / F.col("n_words"), 6).alias("share"))
