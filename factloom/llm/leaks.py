"""Benchmark decontamination, in DataFrame functions alone.

1. Words of texts and items are lower-cased letters and digits; the 5-word shingles of the (small) benchmark meet those
   of every document. A window that is similar to an item shares a shingle with it, so nothing else needs a fingerprint.
2. Every item-sized window of the document that holds as many shared shingles as similarity 0.8 needs is taken, as a
   candidate for that item.
3. Windows and items get 64-bit SimHash fingerprints over their shingles. The 64 bits are cut into RADIUS + 1 blocks;
   fingerprints within RADIUS agree in one block at least, so the multi-index misses none of them: windows and items meet
   by (item, block, its bits), and a pair is taken at its first common block alone.
4. Pairs within RADIUS are verified: weighted Jaccard over shingle counts, at least 0.8.

At similarity 0.8 two fingerprints differ in 9.7 bits on average (standard deviation 2.9); RADIUS is 21, four deviations
more. So wide a radius leaves blocks of two or three bits, which by themselves select nearly nothing; the item in the key
keeps the index from pairing windows with all items of their length, and the Hamming distance itself rejects what shares
shingles in another order of magnitude (unrelated fingerprints differ in 32 bits, deviation 4).

The _outer generators are used on purpose: the plain ones add a filter on the array's size below the scan, which would
compute the shingles of every text a second time, with the words split anew for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

RADIUS = 21
_BLOCKS = [(i * 64 // (RADIUS + 1), (i + 1) * 64 // (RADIUS + 1)) for i in range(RADIUS + 1)]
#: Up to so many benchmark shingles are broadcast (16 bytes each); more are joined by a shuffle.
BROADCAST_SHINGLES = 500_000


def _words(text: str) -> Column:
    plain = F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}\x09-\x0D\x20]+", "")
    return F.filter(F.split(plain, r"[\x09-\x0D\x20]+"), lambda w: w != "")


def _shingles(words: Column, size: int) -> Column:
    """Hashes of all runs of `size` words, in order."""
    n = F.size(words)
    every = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
    return F.when(n >= size, every).otherwise(F.array().cast("array<bigint>"))


def _whole(words: Column, size: int) -> Column:
    """Shingles of a window or item: with fewer words, the whole sequence as one."""
    return F.when(F.size(words) >= size, _shingles(words, size)).otherwise(F.array(F.xxhash64(words)))


def _fingerprint(shingles: Column, width: int) -> tuple[Column, Column]:
    # `width` sums of 64 / width counters each, so that a shingle costs `width` steps and not 64
    counters = 64 // width
    lanes, full = F.lit(sum(1 << width * i for i in range(counters))), F.lit((1 << width) - 1)
    half = F.size(shingles)

    def sums(k: int) -> Column:
        return F.aggregate(shingles, F.lit(0).cast("long"), lambda s, h: s + F.shiftrightunsigned(h, k).bitwiseAND(lanes))

    bits = [F.when(F.shiftrightunsigned(F.get("sums", F.lit(k)), width * lane).bitwiseAND(full) * 2 > half, F.lit(1 << width * lane + k if width * lane + k < 63 else -(1 << 63))).otherwise(F.lit(0)).cast("long") for k in range(width) for lane in range(counters)]
    return F.array(*[sums(k) for k in range(width)]), sum(bits[1:], bits[0])


def _with_fingerprint(df: DataFrame, shingles: str, name: str, width: int) -> DataFrame:
    sums, fp = _fingerprint(F.col(shingles), width)
    return df.withColumn("sums", sums).withColumn(name, fp).drop("sums")


def _blocks(fp: Column) -> Column:
    return F.array(*[F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in _BLOCKS])


def _similarity(a: Column, b: Column) -> Column:
    """Sum of the smaller counts over the sum of the larger ones; both sums follow from the smaller."""
    common = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, g: s + F.least(F.size(F.filter(a, lambda x: x == g)), F.size(F.filter(b, lambda x: x == g))))
    return common / (F.size(a) + F.size(b) - common)


def _starts(ats: Column, need: Column, whole: Column, last: Column) -> Column:
    """Starts, up to `last`, of the windows of `whole` shingles that hold at least `need` of the sorted places.

    Each run of `need` places in a row gives the starts that hold it; what the run before has given is left out.
    """

    def held(i: Column) -> Column:
        low = F.greatest(F.lit(0), F.get(ats, i + need - 1) - whole + 1, F.coalesce(F.get(ats, i - 1) + 1, F.lit(0)))
        high = F.least(F.get(ats, i), last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(ats) - need), held))


def find_leaks(docs: DataFrame, benchmark: DataFrame, size: int = 5, least: float = 0.8) -> DataFrame:
    """docs(doc_id, text, ...), benchmark(item_id, text, ...) -> (doc_id, contaminated, n_items, similarity, item_ids).

    One row for each row of docs; similarity is the best of any item (0 without one). Items with fewer than `size` words
    are one shingle, found where a document has exactly these words in a row. Null and empty texts are clean, null and
    empty items match nothing, repeated rows of an item count once; rows without doc_id are reported clean, repeated rows
    carry the result of their doc_id. Texts of any length are read whole. Only the named columns are read, so other
    names cannot clash.
    """
    items = benchmark.where("item_id is not null").select("item_id", _words("text").alias("words")).where(F.size("words") > 0)
    items = items.withColumn("card", F.xxhash64("item_id", "words")).dropDuplicates(["card"])
    items = items.select("item_id", "card", "words", F.size("words").alias("n"), F.least(F.size("words"), F.lit(size)).alias("gram"), _whole(F.col("words"), size).alias("shingles"))
    grams = [r["gram"] for r in items.select("gram").distinct().collect()]  # at most `size` numbers
    own = [items.where(f"gram = {g}").select("card", "n", F.posexplode_outer(_shingles(F.col("words"), g)).alias("off", "h")) for g in grams]
    hits = None
    for gram, seeds in zip(grams, own):
        if seeds.limit(BROADCAST_SHINGLES + 1).count() <= BROADCAST_SHINGLES:
            seeds = F.broadcast(seeds)
        cut = docs.where("doc_id is not null").select("doc_id", _words("text").alias("words")).select("doc_id", F.size("words").alias("total"), _shingles(F.col("words"), gram).alias("hashes"))
        found = cut.select("doc_id", "total", F.posexplode_outer("hashes").alias("at", "h")).join(seeds, "h")
        found = found.groupBy("doc_id", "total", "card", "n").agg(F.array_sort(F.collect_set("at")).alias("ats"))
        # similarity c / (x + y - c) >= least for sizes x and y needs c >= least * (x + y) / (1 + least) shared places
        whole = F.col("n") - gram + 1
        need = F.ceil(least / (1 + least) * (whole + F.least(F.col("n"), F.col("total")) - gram + 1) - 1e-9).cast("int")
        found = found.withColumn("need", F.greatest(need, F.lit(1))).where(F.size("ats") >= F.col("need"))
        found = found.select("doc_id", "card", "n", _starts(F.col("ats"), F.col("need"), whole, F.greatest(F.col("total") - F.col("n"), F.lit(0))).alias("starts"))
        found = found.where(F.size("starts") > 0)
        hits = found if hits is None else hits.unionByName(found)
    ids = docs.select("doc_id")
    if hits is None:
        return ids.select("doc_id", F.lit(False).alias("contaminated"), F.lit(0).cast("long").alias("n_items"), F.lit(0.0).alias("similarity"), F.array().cast("array<bigint>").alias("item_ids"))
    # the words of a document are cut once for all its candidates; windows of the same words for the same item are one
    hits = hits.groupBy("doc_id", "card", "n").agg(F.array_distinct(F.flatten(F.collect_list("starts"))).alias("starts"))
    places = hits.groupBy("doc_id").agg(F.collect_list(F.struct("card", "n", "starts")).alias("places"))
    held = docs.select("doc_id", "text").join(places, "doc_id").select("doc_id", "places", _words("text").alias("words"))
    held = held.select("doc_id", "words", F.explode_outer("places").alias("p")).select("doc_id", "words", "p.*")
    windows = held.select("doc_id", "card", F.explode_outer(F.transform("starts", lambda x: F.slice("words", x + 1, F.col("n")))).alias("w"))
    windows = windows.select("doc_id", "card", _whole(F.col("w"), size).alias("of_window")).distinct()
    width = 16 if items.agg(F.max("n")).first()[0] < 1 << 16 else 32  # windows are as long as their items, and counters hold their counts
    windows = _with_fingerprint(windows, "of_window", "fp", width)
    cards = _with_fingerprint(items.select("item_id", "card", F.col("shingles").alias("of_item")), "of_item", "item_fp", width)
    left = windows.select("*", F.posexplode_outer(_blocks(F.col("fp"))).alias("block", "bits"))
    right = cards.select("*", F.posexplode_outer(_blocks(F.col("item_fp"))).alias("block", "bits"))
    differ = F.col("fp").bitwiseXOR(F.col("item_fp"))
    agree = F.array(*[F.shiftrightunsigned(differ, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) == 0 for lo, hi in _BLOCKS])
    pairs = left.join(right, ["card", "block", "bits"]).where((F.bit_count(differ) <= RADIUS) & (F.array_position(agree, True) == F.col("block") + 1))
    pairs = pairs.select("doc_id", "item_id", _similarity(F.col("of_window"), F.col("of_item")).alias("similarity")).where(F.col("similarity") >= least)
    leaks = pairs.groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("similarity").alias("similarity"))
    out = ids.join(leaks, "doc_id", "left")
    empty = F.array().cast("array<bigint>")
    return out.select("doc_id", F.col("item_ids").isNotNull().alias("contaminated"), F.size(F.coalesce("item_ids", empty)).cast("long").alias("n_items"), F.coalesce("similarity", F.lit(0.0)).alias("similarity"), F.coalesce("item_ids", empty).alias("item_ids"))


def leaks_sql(least: float = 0.8) -> str:
    """The same in DuckDB SQL, by the shared shingles of all windows; for items of five words and more."""
    words = r"list_filter(string_split_regex(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}\x09-\x0D\x20]+', '', 'g'), '[\x09-\x0D\x20]+'), lambda w: w <> '')"
    grams = "SELECT {id}, len(w) AS total, i - 1 AS p, md5(array_to_string(w[i:i+4], ' ')) AS h FROM (SELECT {id}, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM (SELECT {id}, {words} AS w FROM {table}))"
    return f"""
    WITH d AS ({grams.format(id="doc_id", table="documents", words=words)}),
    b AS ({grams.format(id="item_id", table="benchmark", words=words)}),
    counts AS (SELECT item_id, total AS n, h, count(*) AS c FROM b GROUP BY ALL),
    shared AS (SELECT doc_id, d.total, item_id, n, p, h, c FROM d JOIN counts USING (h)),
    starts AS (SELECT DISTINCT doc_id, total, item_id, n, unnest(range(greatest(p - n + 5, 0), least(p, greatest(total - n, 0)) + 1)) AS s FROM shared),
    held AS (SELECT doc_id, total, item_id, n, s, h, least(count(*), any_value(c)) AS c FROM starts JOIN shared USING (doc_id, total, item_id, n) WHERE p BETWEEN s AND s + n - 5 GROUP BY ALL),
    common AS (SELECT doc_id, total, item_id, n, s, sum(c)::BIGINT AS c FROM held GROUP BY ALL),
    scored AS (SELECT doc_id, item_id, max(c / ((n - 4) + (least(n, total) - 4) - c)) AS x FROM common GROUP BY ALL),
    leaks AS (SELECT doc_id, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS item_ids, count(*) AS n_items, max(x) AS similarity FROM scored WHERE x >= {least} GROUP BY doc_id)
    SELECT doc_id, item_ids IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, coalesce(similarity, 0.0)::DOUBLE AS similarity, coalesce(item_ids, '') AS item_ids
    FROM documents LEFT JOIN leaks USING (doc_id)"""
