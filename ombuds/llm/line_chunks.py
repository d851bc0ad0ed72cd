"""Line dedup over content-defined chunks, with DataFrame functions alone.

Each line has a hash, and a rolling hash runs over the hashes of a line and the lines before it. A chunk ends after a
line whose rolling hash is divisible by ``lines``, which depends on the lines around it only: lines put in or taken out
elsewhere don't move it. A line of at least ``passage_words`` words is a chunk of its own. A chunk of several lines, or
of one such long line, stays where it occurs first (smallest id, then place) and goes wherever it comes again.

A chunk of one short line is too little to go by itself. It is taken together with the chunk before it and with the one
after it, and goes where one of these pairs comes again. So a copied text goes as a whole. What goes always has an
equal line before it in that order, so each line stays somewhere.

Repeats are found by chunk hashes alone, so no text is shuffled for them. Only chunks of repeated hashes are then
joined, by hash and text: the text is compared byte by byte. The first text of a chunk is joined once for each
``SALT_ROWS`` of its repeats, which are dealt over as many keys, so a common passage is no one task's work.

Where chunks end depends on the lines around a passage, so its borders may stay. ``borders`` takes them too: from each
line on, and back from each line, the fewest lines that reach ``passage_words`` words are a run, and a run of several
lines goes wherever it comes again. The runs of a passage of that many words cover all its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ombuds.llm.common import keeps_names, small_or_shuffled, written

LINES, WINDOW, PASSAGE_WORDS = 2, 2, 50
SALT_ROWS, FEW = 1000, 6
PRIME, FACTOR = 2_147_483_647, 1_000_003
LAST_ID = (1 << 63) - 1


def _hash(value: Column) -> Column:
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("long")


def _chunked(docs: DataFrame, text: str, lines: int, window: int, passage_words: int) -> DataFrame:
    """``docs`` with ``__lines`` and ``__ends``, the number of the last line of each chunk (from 1)."""
    split = docs.withColumn("__lines", F.split(F.col(f"`{text}`"), "\n", -1))
    hashed = split.withColumn("__hashes", F.transform("__lines", lambda x: _hash(x) % PRIME)).withColumn(
        "__long",
        F.transform("__lines", lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "))) + 1 >= passage_words),
    )

    def rolling(i: Column) -> Column:
        total = F.lit(0).cast("long")
        for back in range(window - 1, -1, -1):
            before = F.when(i > back, F.get("__hashes", i - 1 - back)).otherwise(F.lit(0).cast("long"))
            total = (total * FACTOR + before) % PRIME
        return total

    def ends(i: Column) -> Column:
        here, after = F.get("__long", i - 1), F.coalesce(F.get("__long", i), F.lit(True))
        return here | after | (rolling(i) % lines == 0)

    numbers = F.sequence(F.lit(1), F.size("__lines"))
    cut = hashed.withColumn("__ends", F.filter(numbers, ends))
    return cut.drop("__hashes", "__long")


def _first(k: Column) -> Column:
    """The first line of chunk ``k`` (both from 1)."""
    return F.when(k > 1, F.get("__ends", k - 2) + 1).otherwise(1)


def _text(k: Column) -> Column:
    first = _first(k)
    return F.array_join(F.slice("__lines", first, F.get("__ends", k - 1) - first + 1), "\n")


def _blank(chunk: Column) -> Column:
    return F.trim(F.replace(chunk, F.lit("\n"))) == ""


def _occurrences(chunked: DataFrame, passage_words: int) -> DataFrame:
    """A row for each chunk that may go, and what decides it: ``id, mark, top, last, at, chunk, c``. ``top`` and ``last``
    are its lines, ``chunk`` its own text, or for a short line that of a pair, ``at`` the number of the chunk where it
    begins, and ``c`` its hash."""
    numbers = F.sequence(F.lit(1), F.size("__ends"))
    texts = chunked.select("id", "mark", "__ends", F.transform(numbers, _text).alias("__chunks"))

    def lines_of(k: Column) -> list[Column]:
        return [_first(k).alias("top"), F.get("__ends", k - 1).alias("last")]

    def pair(at: Column, k: Column) -> Column:
        one, two = F.get("__chunks", at - 1), F.get("__chunks", at)
        both = F.when(~_blank(one) & ~_blank(two), F.concat_ws("\n", one, two))
        return F.struct(*lines_of(k), at.alias("at"), both.alias("chunk"))

    def decided_by(k: Column) -> Column:
        chunk = F.get("__chunks", k - 1)
        words = F.length(chunk) - F.length(F.replace(chunk, F.lit(" "))) + 1
        several = (F.get("__ends", k - 1) > _first(k)) | (words >= passage_words)
        own = F.struct(*lines_of(k), k.alias("at"), F.when(~_blank(chunk), chunk).alias("chunk"))
        return F.when(several, F.array(own)).otherwise(F.array(pair(k - 1, k), pair(k, k)))

    rows = texts.select("id", "mark", F.inline(F.flatten(F.transform(numbers, decided_by))))
    return rows.where(F.col("chunk").isNotNull()).withColumn("c", _hash(F.col("chunk")))


def _runs(split: DataFrame, passage_words: int) -> DataFrame:
    """``id, mark, top, last, at, c`` for each run of several lines: from each line that is not blank, on and back, the
    fewest lines that reach ``passage_words`` words. Blank lines have no words and begin or end no run."""
    line = lambda i: F.get("__lines", i - 1)
    filled = F.filter(F.sequence(F.lit(1), F.size("__lines")), lambda i: ~_blank(line(i)))
    hashed = split.select("id", "mark", "__lines", filled.alias("__filled")).select(
        "id",
        "mark",
        "__filled",
        F.transform("__filled", lambda i: F.length(line(i)) - F.length(F.replace(line(i), F.lit(" "))) + 1).alias("__words"),
        F.transform("__lines", lambda x: F.xxhash64(x)).alias("__hashes"),
    )

    # A column of its own: within the functions of each line it would be made anew for each.
    hashed = hashed.withColumn("__back", F.reverse("__words"))

    def reach(words: Column, begun: Column) -> Column:
        more = lambda x, n: F.struct(x["m"].alias("m"), (x["words"] + n).alias("words"), (x["n"] + 1).alias("n"))
        return F.aggregate(words, begun, lambda x, n: F.when(x["words"] < passage_words, more(x, n)).otherwise(x))

    def reached(words: Column) -> Column:
        """For each line ``m``, how many lines from it on reach enough words. Few do mostly, so few are looked at first;
        a line has one word at least, so ``passage_words`` of them are enough."""
        places = F.when(F.size(words) > 0, F.sequence(F.lit(1), F.size(words)))
        none = lambda m: F.struct(m.alias("m"), F.lit(0).alias("words"), F.lit(0).alias("n"))
        few = F.transform(places, lambda m: reach(F.slice(words, m, FEW), none(m)))
        rest = lambda x: reach(F.slice(words, x["m"] + FEW, passage_words), x)
        every = F.transform(few, lambda x: F.when(x["words"] >= passage_words, x).otherwise(rest(x)))
        return F.filter(every, lambda x: (x["words"] >= passage_words) & (x["n"] > 1))

    def between(top: Column, last: Column) -> Column:
        return F.struct(F.get("__filled", top - 1).alias("top"), F.get("__filled", last - 1).alias("last"))

    count = F.size("__filled")
    on = F.transform(reached(F.col("__words")), lambda x: between(x["m"], x["m"] + x["n"] - 1))
    back = F.transform(
        reached(F.col("__back")), lambda x: between(count - x["m"] - x["n"] + 2, count - x["m"] + 1)
    )
    found = hashed.select("id", "mark", "__hashes", F.inline(F.array_union(on, back)))
    c = F.xxhash64(F.slice("__hashes", F.col("top"), F.col("last") - F.col("top") + 1))
    return found.select("id", "mark", "top", "last", F.col("top").alias("at"), c.alias("c"))


def _again(found: DataFrame, label: str) -> DataFrame:
    """``c, first, salts`` of the hashes that occur at several places."""
    here = F.struct("id", "mark", "at")
    again = found.groupBy("c").agg(F.min(here).alias("first"), F.max(here).alias("last"), F.count("*").alias("n"))
    again = again.where("first <> last").select("c", "first", F.expr(f"int(n div {SALT_ROWS}) + 1").alias("salts"))
    return small_or_shuffled(again, label, 68)


@keeps_names
def dedup_lines(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    lines: int = LINES,
    window: int = WINDOW,
    passage_words: int = PASSAGE_WORDS,
    report: bool = False,
    borders: bool = False,
) -> DataFrame:
    """``docs`` with repeated chunks taken out of the texts, and with ``borders`` all repeated passages of whole lines
    and at least ``passage_words`` words; with ``report`` also ``n_lines``, ``n_chunks``, ``removed_chunks`` (of which
    no line stays) and ``removed_lines``.

    A null text stays null and an empty one empty; a text whose chunks all go becomes empty, and its row stays. Rows
    of one id and text are one document and get the same text. Rows of one id and different texts are different
    documents, ordered by a hash of the text; a null id comes last. Blank chunks stay. Texts of any length are
    chunked whole. All columns of ``docs`` pass through.
    """
    body = F.col(f"`{text}`")
    marked = docs.withColumn("__id", F.coalesce(F.col(f"`{id}`").cast("long"), F.lit(LAST_ID)))
    marked = marked.withColumn("__mark", F.xxhash64(body))
    plain = marked.select(F.col("__id").alias("id"), F.col("__mark").alias("mark"), body.alias("text"))
    chunked = _chunked(plain.where(F.length("text") > 0), "text", lines, window, passage_words)
    found = _occurrences(chunked, passage_words)
    here = F.struct("id", "mark", "at")
    kept = ["c", "id", "mark", "top", "last", "at", "chunk", "first", "salts"]
    repeated = found.join(_again(found, "chunk-hashes"), "c").select(*kept)
    if borders:
        runs, _ = written(_runs(chunked, passage_words), "runs")
        runs = runs.join(_again(runs, "run-hashes"), "c")
        # As many as twice the document's lines at most; the texts are taken from the document.
        runs = runs.groupBy("id", "mark").agg(F.collect_set(F.struct("c", "top", "last", "at", "first", "salts")).alias("runs"))
        whole = chunked.select("id", "mark", "__lines").join(runs, ["id", "mark"]).select("id", "mark", "__lines", F.inline("runs"))
        body_of = F.array_join(F.slice("__lines", F.col("top"), F.col("last") - F.col("top") + 1), "\n")
        repeated = repeated.unionByName(whole.withColumn("chunk", body_of).select(*kept))
    repeated, _ = written(repeated, "chunks")
    owners = repeated.where(here == F.col("first")).select("c", "chunk", "salts").distinct()
    owners = owners.select("c", "chunk", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    # Equal hashes are not enough: the texts must be equal too.
    salt = F.pmod(F.xxhash64("id", "mark", "at"), F.col("salts")).cast("int")
    gone = repeated.where(here != F.col("first")).withColumn("salt", salt)
    gone = gone.join(owners, ["c", "chunk", "salt"], "left_semi")
    # As many places as the document has chunks and runs at most.
    gone = gone.groupBy("id", "mark").agg(F.collect_set(F.struct("top", "last")).alias("__places"))
    places = F.transform("__places", lambda x: F.sequence(x["top"], x["last"]))
    gone = gone.select(
        F.col("id").alias("__id"), F.col("mark").alias("__mark"), F.array_distinct(F.flatten(places)).alias("__gone")
    )

    joined = marked.join(gone, ["__id", "__mark"], "left")
    cut = _chunked(joined, text, lines, window, passage_words)
    stays = F.array_except(F.sequence(F.lit(1), F.size("__lines")), "__gone")
    rest = F.array_join(F.transform(stays, lambda i: F.get("__lines", i - 1)), "\n")
    columns = [
        F.when(F.col("__gone").isNull(), body).otherwise(rest).alias(text) if name == text else F.col(f"`{name}`")
        for name in docs.columns
    ]
    if report:
        chunks = F.sequence(F.lit(1), F.size("__ends"))
        chunk_of = F.flatten(F.transform(chunks, lambda k: F.array_repeat(k, F.get("__ends", k - 1) - _first(k) + 1)))
        cut = cut.withColumn("__chunk_of", F.when(F.col("__gone").isNotNull(), chunk_of))
        left = F.size(F.array_distinct(F.transform(stays, lambda i: F.get("__chunk_of", i - 1))))
        columns += [
            F.coalesce(F.size("__lines"), F.lit(0)).alias("n_lines"),
            F.coalesce(F.size("__ends"), F.lit(0)).alias("n_chunks"),
            F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__ends") - left).alias("removed_chunks"),
            F.coalesce(F.size("__gone"), F.lit(0)).alias("removed_lines"),
        ]
    return cut.select(*columns)


#: What ``report`` gives for ``documents``, in DuckDB: windows and lists of rows instead of arrays. Ids are unique there.
ORACLE = f"""
WITH lines AS (
  SELECT doc_id, line, place FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents WHERE length(text) > 0)
), hashed AS (
  SELECT *, ('0x' || substr(md5(line), 1, 15))::BIGINT % {PRIME} AS h,
         length(line) - length(replace(line, ' ', '')) + 1 >= {PASSAGE_WORDS} AS long FROM lines
), rolled AS (
  SELECT *, (coalesce(lag(h) OVER w, 0) * {FACTOR} + h) % {PRIME} AS r,
         coalesce(lead(long) OVER w, true) AS long_next FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY place)
), ended AS (
  SELECT *, long OR long_next OR r % {LINES} = 0 AS ends FROM rolled
), numbered AS (
  SELECT *, 1 + coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY place
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM ended
), chunks AS (
  SELECT doc_id, k, count(*) AS n, string_agg(line, chr(10) ORDER BY place) AS chunk FROM numbered GROUP BY ALL
), sized AS (
  SELECT *, n > 1 OR length(chunk) - length(replace(chunk, ' ', '')) + 1 >= {PASSAGE_WORDS} AS several,
         CASE WHEN trim(replace(chunk, chr(10), ''), ' ') <> '' THEN chunk END AS filled FROM chunks
), beside AS (
  SELECT *, lag(filled) OVER w AS before, lead(filled) OVER w AS after FROM sized WINDOW w AS (PARTITION BY doc_id ORDER BY k)
), deciding AS (
  SELECT doc_id, k, k AS begins, filled AS body FROM beside WHERE several
  UNION ALL SELECT doc_id, k, k - 1, before || chr(10) || filled FROM beside WHERE NOT several
  UNION ALL SELECT doc_id, k, k, filled || chr(10) || after FROM beside WHERE NOT several
), again AS (
  SELECT DISTINCT doc_id, k FROM (
    SELECT doc_id, k, dense_rank() OVER (PARTITION BY body ORDER BY doc_id, begins) AS place FROM deciding WHERE body IS NOT NULL)
  WHERE place > 1
), judged AS (
  SELECT c.*, g.k IS NOT NULL AS gone FROM chunks c LEFT JOIN again g ON c.doc_id = g.doc_id AND c.k = g.k
), cut AS (
  SELECT doc_id, sum(n) AS n_lines, count(*) AS n_chunks, count(*) FILTER (gone) AS removed_chunks,
         coalesce(sum(n) FILTER (gone), 0) AS removed_lines,
         coalesce(string_agg(chunk, chr(10) ORDER BY k) FILTER (NOT gone), '') AS text FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, CASE WHEN d.text IS NULL THEN 0 ELSE 1 END)::INT AS n_lines,
       coalesce(n_chunks, CASE WHEN d.text IS NULL THEN 0 ELSE 1 END)::INT AS n_chunks,
       coalesce(removed_chunks, 0)::INT AS removed_chunks, coalesce(removed_lines, 0)::INT AS removed_lines,
       length(coalesce(c.text, d.text)) AS n_chars, md5(coalesce(c.text, d.text)) AS text_md5
FROM documents d LEFT JOIN cut c ON d.doc_id = c.doc_id
"""
