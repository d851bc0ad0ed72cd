"""Benchmark decontamination by fingerprints of item-sized windows, with DataFrame functions alone.

A window of a document that is similar to a benchmark item shares a shingle with it. So windows are laid where a
shingle of a document is one of the benchmark: as wide as the item, and placed so that the shared shingles lie over
each other. Each window and each item gets a SimHash fingerprint of its shingles. The four 16-bit blocks of an item's
fingerprint are posted with up to ``RADIUS // 4`` bits changed, those of a window as they are: fingerprints that differ
in at most ``RADIUS`` bits differ in that few bits in one block at least, so all such pairs meet. The pairs that meet
within the radius are candidates; the shingles, weighted by how often they occur, decide.

For similarity 0.8 a fingerprint differs in about 10 bits with a deviation of 3, for an exact copy in none. The radius
is the largest that four changed bits a block cover.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ombuds.llm.common import keeps_names, small_or_shuffled, written

WORDS, SIMILARITY, RADIUS, BLOCKS = 5, 0.8, 19, 4
#: Left out of words, so that quotes and full stops don't hide a copy.
PUNCTUATION = ".,;:!?\"'()[]{}"
#: Of a place in an array of structs: an offset and three fields.
PLACE_BYTES = 40
LANES = 0x0000_0001_0000_0001


def _words(text: Column) -> Column:
    plain = F.translate(F.lower(F.coalesce(text, F.lit(""))), PUNCTUATION, "")
    return F.filter(F.split(plain, "\\s+"), lambda word: word != "")


def _shingles(words: str, width: int | Column) -> Column:
    """Hashes of all runs of ``width`` words; none if there are fewer words."""
    count = F.size(words) - width + 1
    each = F.transform(F.sequence(F.lit(1), count), lambda i: F.xxhash64(F.slice(words, i, width)))
    return F.when(count > 0, each).otherwise(F.array().cast("array<long>"))


def _fingerprints(rows: DataFrame, by: list[str]) -> DataFrame:
    """``by`` and ``fp``, the majority bits over the ``shingle`` column of each group.

    Two bits are counted by one sum, in the halves of a long.
    """
    halves = [
        F.sum(F.shiftrightunsigned("shingle", bit).bitwiseAND(F.lit(LANES))).alias(f"__{bit}") for bit in range(32)
    ]
    counted = rows.groupBy(*by).agg(F.count("*").alias("__n"), *halves)

    def bit(number: int) -> Column:
        lane = F.col(f"__{number % 32}")
        ones = F.shiftright(lane, 32) if number >= 32 else lane.bitwiseAND(F.lit(0xFFFF_FFFF))
        value = (1 << number) - (1 << 64 if number == 63 else 0)
        return F.when(ones * 2 > F.col("__n"), F.lit(value).cast("long")).otherwise(F.lit(0).cast("long"))

    return counted.select(*by, reduce(Column.bitwiseOR, map(bit, range(64))).alias("fp"))


def _items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """``item`` (its id and a hash of its text), ``n`` (words), ``width`` (words of a shingle), ``shingles``."""
    body = F.col(f"`{text}`")
    plain = benchmark.select(F.struct(F.col(f"`{item}`").alias("id"), F.xxhash64(body)).alias("item"), _words(body).alias("words"))
    sized = plain.withColumn("n", F.size("words")).where("n > 0").withColumn("width", F.least("n", F.lit(WORDS)))
    return sized.select("item", "n", "width", _shingles("words", F.col("width")).alias("shingles")).distinct()


def _block(fp: Column, number: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * number).bitwiseAND(F.lit(0xFFFF)).cast("int")


def _meeting(windows: DataFrame, items: DataFrame) -> DataFrame:
    """``doc, start, n, item`` for fingerprints of equal ``n`` that differ in at most ``RADIUS`` bits."""
    changes = F.lit([c for c in range(1 << 16) if c.bit_count() <= RADIUS // BLOCKS])
    blocks = F.array(*(F.struct(F.lit(b).alias("b"), _block(F.col("fp"), b).alias("v")) for b in range(BLOCKS)))
    posted = items.select("item", "n", "fp", F.inline(blocks)).select("*", F.explode(changes).alias("change"))
    posted = posted.select("item", "n", F.col("fp").alias("item_fp"), "b", F.col("v").bitwiseXOR(F.col("change")).alias("v"))
    sought = windows.select("doc", "start", "n", "fp", F.inline(blocks))
    near = sought.join(small_or_shuffled(posted, "item-blocks", 192), ["n", "b", "v"])
    return near.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS).select(
        "doc", "start", "n", "item"
    ).distinct()


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``doc`` (a struct of the id and the hash of the text), ``item_id, similarity, start`` (word, from 0) for each
    document and item with a window of at least that similarity: the most similar window, the first of equals.

    Similarity is the sum of the smaller counts of each shingle over the sum of the larger ones. Shingles are five
    words, or the whole item if it has fewer. A document shorter than the item is one window. Null and empty texts
    and items contain nothing. Rows of one id and text are one document or item, a null id is an id like any other,
    and items of equal texts are each reported. Empty tables give no rows; other columns don't matter.
    """
    items, _ = written(_items(benchmark, item, item_text), "items")
    parts = items.select("item", "n", "width", F.posexplode("shingles").alias("q", "shingle"))
    anchors = small_or_shuffled(parts.select("n", "width", "q", "shingle").distinct(), "item-shingles", 32)
    widths = [row.width for row in items.select("width").distinct().collect()]  # WORDS of them at most
    body = F.col(f"`{text}`")
    plain = docs.select(document(id, text).alias("doc"), _words(body).alias("words"))

    # Where windows lie: as wide as an item, and placed so that a shared shingle lies over itself.
    found = [plain.select("doc", *(F.lit(0).alias(x) for x in ("n", "width", "start"))).where("false")]
    for width in widths:
        each = F.posexplode(_shingles("words", width)).alias("p", "shingle")
        placed = plain.select("doc", F.size("words").alias("size"), each)
        shared = placed.join(anchors.where(F.col("width") == width), "shingle")
        start = F.greatest(F.lit(0), F.least(F.col("p") - F.col("q"), F.col("size") - F.col("n")))
        found.append(shared.select("doc", "n", "width", start.alias("start")))
    # A document has as many places as words times widths of items at most.
    laid = reduce(DataFrame.union, found).distinct()
    laid = laid.groupBy("doc").agg(F.collect_list(F.struct("n", "width", "start")).alias("laid"))
    laid = small_or_shuffled(laid, "places", 512 + PLACE_BYTES * F.size("laid").cast("long"))
    hit = plain.join(laid, "doc").select("doc", "words", F.explode("laid").alias("x")).select("doc", "words", "x.*")
    hit = hit.withColumn("words", F.slice("words", F.col("start") + 1, F.col("n")))
    windows = hit.select("doc", "start", "n", _shingles("words", F.least("width", F.size("words"))).alias("shingles"))
    windows, _ = written(windows.dropDuplicates(["doc", "start", "n"]), "windows")

    window = ["doc", "start", "n"]
    near = _meeting(
        _fingerprints(windows.select(*window, F.explode("shingles").alias("shingle")), window),
        _fingerprints(parts, ["item", "n"]),
    )
    # The exact check of the candidates.
    pair = [*window, "item", "size"]
    sides = near.join(windows, window).select(*window, "item", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    weights = sides.groupBy(*pair, "shingle").agg(F.count("*").alias("w"))
    item_weights = parts.groupBy("item", "shingle").agg(F.count("*").alias("item_w"))
    sizes = items.select("item", F.size("shingles").alias("item_size"))
    both = weights.join(item_weights, ["item", "shingle"]).join(sizes, "item")
    common = both.groupBy(*pair, "item_size").agg(F.sum(F.least("w", "item_w")).alias("common"))
    alike = F.col("common") / (F.col("size") + F.col("item_size") - F.col("common"))
    best = common.select("doc", "item", F.struct(alike.alias("similarity"), (-F.col("start")).alias("back")).alias("x"))
    best = best.where(F.col("x.similarity") >= similarity).groupBy("doc", "item").agg(F.max("x").alias("x"))
    return best.select("doc", F.col("item.id").alias(item), "x.similarity", (-F.col("x.back")).alias("start"))


def document(id: str = "doc_id", text: str = "text") -> Column:
    """What names a document here: its id, which may be null, and a hash of its text."""
    return F.struct(F.col(f"`{id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("mark"))


@keeps_names
def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without any window like a benchmark item, all columns unchanged."""
    found = contaminated(docs, benchmark, id, text).select(F.col("doc").alias("__doc")).distinct()
    return docs.withColumn("__doc", document(id, text)).join(found, "__doc", "left_anti").drop("__doc")


def _oracle() -> str:
    """The exact similarity of all windows, in DuckDB, where fingerprints take no part."""

    def words(text: str) -> str:
        plain = f"translate(lower({text}), '{PUNCTUATION.replace(chr(39), chr(39) * 2)}', '')"
        return f"list_filter(regexp_split_to_array({plain}, '\\s+'), lambda x: x <> '')"

    def shingles(words: str, width: str) -> str:
        return f"list_transform(range(1, len({words}) - {width} + 2), lambda i: array_to_string({words}[i : i + {width} - 1], ' '))"

    return f"""
WITH items AS (
  SELECT item_id, w, len(w) AS n, least(len(w), {WORDS}) AS width FROM (SELECT item_id, {words("text")} AS w FROM benchmark)
  WHERE len(w) > 0
), item_shingles AS (
  SELECT item_id, n, width, s AS shingle, q FROM (
    SELECT item_id, n, width, unnest({shingles("w", "width")}) AS s,
           generate_subscripts({shingles("w", "width")}, 1) AS q FROM items)
), docs AS (
  SELECT doc_id, {words("text")} AS w FROM documents WHERE text IS NOT NULL
), doc_shingles AS (
  SELECT doc_id, size, width, s AS shingle, p FROM (
    SELECT doc_id, len(w) AS size, width, unnest({shingles("w", "width")}) AS s,
           generate_subscripts({shingles("w", "width")}, 1) AS p FROM docs, (SELECT DISTINCT width FROM items))
), places AS (
  SELECT DISTINCT doc_id, item_id, n, i.width, greatest(0, least(p - q, size - n)) AS start
  FROM doc_shingles d JOIN item_shingles i ON d.shingle = i.shingle AND d.width = i.width
), windows AS (
  SELECT doc_id, start, n, width, {shingles("x", "least(width, len(x))")} AS s FROM (
    SELECT doc_id, start, n, width, w[start + 1 : start + n] AS x
    FROM (SELECT DISTINCT doc_id, start, n, width FROM places) JOIN docs USING (doc_id))
), window_weights AS (
  SELECT doc_id, start, n, len(s) AS size, shingle, count(*) AS w FROM (
    SELECT *, unnest(s) AS shingle FROM windows) GROUP BY ALL
), item_weights AS (
  SELECT item_id, n, n - width + 1 AS item_size, shingle, count(*) AS w FROM item_shingles GROUP BY ALL
), alike AS (
  SELECT doc_id, item_id, start, sum(least(a.w, b.w)) AS common, any_value(size) AS size, any_value(item_size) AS item_size
  FROM window_weights a JOIN item_weights b ON a.n = b.n AND a.shingle = b.shingle GROUP BY ALL
), scored AS (
  SELECT doc_id, item_id, start, common::DOUBLE / (size + item_size - common) AS similarity FROM alike
)
SELECT doc_id, item_id, similarity, start::INT AS start FROM scored WHERE similarity >= {SIMILARITY}
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""


#: Ids are unique in the given tables.
ORACLE = _oracle()
