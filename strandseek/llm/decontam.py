"""Operator 3, benchmark decontamination by winnowing, in DataFrame operations only.

Of every 13 words in a row the least hash of their 5-word grams is kept, at its leftmost place, and
each place once however many windows keep it: about a fifth of all places, in documents and in the
benchmark alike. A shared span of 13 words has the same least gram on both sides, so joining the
fingerprints misses nothing. A hit is then extended: the words before and behind the gram, as many
as a window around it can hold, are compared one by one in both directions, and where the common
stretch is a whole window long all of it is hit. An item of under 13 words is one window; documents
are winnowed for each length that occurs, all in one pass.

Each fingerprint carries only the words around it, never the document. A document's fingerprint is
joined with one row of the benchmark, which lists the contexts of its gram, so a gram that many items
share doesn't multiply rows.

Defined cases: a null or empty text has no words, no hits and isn't contaminated; an item without
words has no windows; a null item id is written as an empty string; items of one id are one item;
rows are told apart by key and text, so repeated rows give repeated rows, and a null key stays
null; a very long text is worked on whole, in time and memory proportional to its words; of equal
least grams in a window the leftmost is kept, on both sides; an empty benchmark hits nothing; an
empty table gives an empty table of the same columns; other columns may have any names.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandseek.llm._text import column, fresh

WINDOW, GRAM = 13, 5
#: What ends a word, once A-Z are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The benchmark's fingerprints are broadcast up to so many of them, and so many words and ids around them; beyond, joins shuffle.
BROADCAST_PRINTS, BROADCAST_STRINGS = 200_000, 4_000_000


def lower_ascii(text: Column) -> Column:
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """The words of a text, of a null none."""
    return F.coalesce(F.array_remove(F.split(lower_ascii(text), BETWEEN), ""), F.array().cast("array<string>"))


def numbers(size: Column, span: int) -> Column:
    """0 to size - span, if there are any."""
    return F.when(size >= span, F.sequence(F.lit(0), size - span)).otherwise(F.array().cast("array<int>"))


def least_of(source: str, times: int, step: int) -> Column:
    """For each place the least of ``times`` elements, ``step`` apart."""
    return F.transform(numbers(F.size(source), (times - 1) * step + 1), lambda i: F.least(*[F.get(source, i + k * step) for k in range(times)]))


def grams_of(length: int, gram: int) -> int:
    """How many words a gram has in windows of so many."""
    return min(gram, length)


def selected(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Adds ``kept`` to rows with ``h``, the words' hashes: what winnowing keeps of windows of ``length`` words.

    An element holds half of a gram's hash above its place, so the least of a window is the leftmost of
    its least grams; halves of different grams that agree cost a comparison, no result. Each step is a
    projection of its own whose result is used more than once, so that the optimiser doesn't write one
    step into the next one's lambda and repeat it for every element. For the same reason callers use
    outer explodes: from others it infers a filter on the array's size and pushes that, with all steps
    written out, to the scan.
    """
    k = grams_of(length, gram)
    hashed = lambda i: F.xxhash64(*[F.get("h", i + j) for j in range(k)])
    rows = rows.withColumn("m0", F.transform(numbers(F.size("h"), k), lambda i: hashed(i).bitwiseAND(F.lit(-1 << 32)).bitwiseOR(i.cast("long"))))
    left, spread, at = length - k + 1, 1, 0  # how many grams, of which so many are already joined
    while spread < left:
        times = 3 if spread * 3 <= left else 2
        step = spread if spread * times <= left else left - spread
        rows = rows.withColumn(f"m{at + 1}", least_of(f"m{at}", times, step))
        spread = spread + (times - 1) * step
        at += 1
    kept = F.col(f"m{at}")
    # the place that windows keep grows with them, so equal ones are neighbours
    once = F.filter(kept, lambda x, i: (i == 0) | (x != F.get(kept, i - 1)))
    return rows.withColumn("kept", once).drop(*(f"m{j}" for j in range(at + 1)))


def around(length: int, k: int, kept: Column) -> Column:
    """A kept place with the words around it that a window could hold, of which ``lead`` are before the gram."""
    at, reach = kept.bitwiseAND(F.lit((1 << 32) - 1)).cast("int"), length - k
    return F.struct(
        F.lit(length).alias("length"),
        F.shiftright(kept, 32).cast("int").alias("print"),
        at.alias("at"),
        F.least(at, F.lit(reach)).alias("lead"),
        F.slice("words", F.greatest(at - reach, F.lit(0)) + 1, F.least(at, F.lit(reach)) + k + reach).alias("around"),
    )


def opened_up(rows: DataFrame, gram: int) -> DataFrame:
    """Fingerprints with ``before`` (from the gram to the left), ``words_of_gram`` and ``behind`` for their words around: for those few that are looked at."""
    k = F.least(F.lit(gram), F.col("length"))
    return rows.withColumns({
        "before": F.reverse(F.slice("around", F.lit(1), F.col("lead"))),
        "words_of_gram": F.slice("around", F.col("lead") + 1, k),
        "behind": F.slice("around", F.col("lead") + k + 1, F.col("length") - k),
    }).drop("around", "lead")


def prints_of(rows: DataFrame, lengths: list[int], window: int, gram: int) -> DataFrame:
    """Of rows with ``words`` a row a fingerprint, with what ``around`` gives; other columns go along."""
    carried = [column(c) for c in rows.columns if c != "words"]
    rows = rows.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    parts = []
    for length in lengths:
        k = grams_of(length, gram)
        rows = selected(rows, length, gram).withColumnRenamed("kept", f"kept{length}")
        parts.append(F.transform(f"kept{length}", partial(around, length, k)))
    return rows.select(*carried, F.explode_outer(F.concat(*parts)).alias("f")).where(F.col("f").isNotNull()).select(*carried, "f.*")


def agreeing(a: Column, b: Column) -> Column:
    """With how many elements both arrays begin alike."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(False)).cast("int")
    return F.when(differ == 0, F.size(a)).otherwise(differ - 1)


def known_prints(items: DataFrame, key: str, text: str, window: int, gram: int) -> tuple[DataFrame, list[int]]:
    """length, print and contexts (before, words_of_gram, behind and the ids of the items that have it) of the benchmark, and its lengths."""
    rows = items.select(F.coalesce(column(key).cast("string"), F.lit("")).alias("item"), words_of(column(text).cast("string")).alias("words"))
    rows = rows.where(F.size("words") > 0).withColumn("of", F.least(F.size("words"), F.lit(window)))
    lengths = sorted(r["of"] for r in rows.select("of").distinct().collect())  # at most ``window``
    found = opened_up(prints_of(rows, lengths, window, gram).where("length = of"), gram) if lengths else None
    if found is None:
        return rows.sparkSession.createDataFrame([], "length int, print int, contexts array<struct<before:array<string>,words_of_gram:array<string>,behind:array<string>,items:array<string>>>"), []
    context = ["before", "words_of_gram", "behind"]
    found = found.groupBy("length", "print", *context).agg(F.collect_set("item").alias("items"))
    return found.groupBy("length", "print").agg(F.collect_list(F.struct(*context, "items")).alias("contexts")), lengths


def judged(docs: DataFrame, items: DataFrame, key: str, text: str, item: str, item_text: str, window: int, gram: int) -> DataFrame:
    """The result of ``decontaminate`` with ``row``, a hash of the text."""
    base = docs.select(column(key).cast("long").alias("doc_id"), column(text).cast("string").alias("text"))
    base = base.withColumn("row", F.xxhash64("text"))
    spaced = base.select("doc_id", "row", words_of(F.col("text")).alias("words"))
    known, lengths = known_prints(items, item, item_text, window, gram)
    rows = spaced.select("doc_id", "row", F.size("words").cast("long").alias("n_words"))
    if not lengths:
        rows = rows.withColumns({"n_hit": F.lit(0).cast("long"), "listed": F.array().cast("array<string>")})
    else:
        words = lambda c: F.size(c["before"]) + F.size(c["words_of_gram"]) + F.size(c["behind"])
        held = F.aggregate("contexts", F.lit(0).cast("long"), lambda s, c: s + words(c) + F.size(c["items"]))
        size = known.agg(F.count("*").alias("n"), F.sum(held).alias("strings")).first()
        small = size["n"] <= BROADCAST_PRINTS and size["strings"] <= BROADCAST_STRINGS
        found = opened_up(prints_of(spaced, lengths, window, gram).join(F.broadcast(known) if small else known, ["length", "print"]), gram)
        left, right = (lambda c: agreeing(c["before"], F.col("before"))), (lambda c: agreeing(c["behind"], F.col("behind")))
        grown = F.transform("contexts", lambda c: F.struct(F.when(c["words_of_gram"] == F.col("words_of_gram"), left(c)).alias("left"), right(c).alias("right"), c["items"].alias("items")))
        k = F.size("words_of_gram")
        whole = F.filter(grown, lambda c: c["left"] + c["right"] + k >= F.col("length"))
        hits = found.select("doc_id", "row", "at", "length", "words_of_gram", F.explode(whole).alias("c"))
        hits = hits.select("doc_id", "row", (F.col("at") - F.col("c.left")).alias("at"), (F.col("at") + k + F.col("c.right")).alias("end"), "c.items")
        per = hits.groupBy("doc_id", "row").agg(
            F.sort_array(F.collect_set(F.struct("at", "end"))).alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("listed")
        )
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))
        covered = F.aggregate(
            "spans",
            start,
            lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["at"], s["to"]))).alias("n"), F.greatest(s["to"], x["end"]).alias("to")),
            lambda s: s["n"].cast("long"),
        )
        per = per.select(F.col("doc_id").alias("of"), F.col("row").alias("of_row"), covered.alias("n_hit"), "listed")
        rows = rows.join(per, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("row") == F.col("of_row")), "left")
    n_hit, listed = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("listed", F.array().cast("array<string>"))
    return rows.select(
        "doc_id",
        "row",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    return judged(docs, items, key, text, item, item_text, window, gram).drop("row")


def keep_clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The rows of docs, with all columns, that aren't contaminated."""
    its_key, its_row = fresh(docs, names=("its_key", "its_row"))
    bad = judged(docs, items, key, text, item, item_text, window, gram).where("contaminated").select(F.col("doc_id").alias(its_key), F.col("row").alias(its_row)).distinct()
    return docs.join(bad, column(key).cast("long").eqNullSafe(F.col(its_key)) & (F.xxhash64(column(text).cast("string")) == F.col(its_row)), "left_anti")


#: The same in SQL.
DECONTAMINATE_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
        coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
    b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
        coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
    bl AS (SELECT item, w, least(len(w), 13) AS l FROM b WHERE len(w) > 0),
    bw AS (SELECT DISTINCT item, l, array_to_string(w[i + 1 : i + l], ' ') AS said FROM (SELECT item, w, l, unnest(range(len(w) - l + 1)) AS i FROM bl)),
    ls AS (SELECT DISTINCT l FROM bw),
    dw AS (SELECT r, l, i, array_to_string(w[i + 1 : i + l], ' ') AS said FROM (SELECT r, w, l, unnest(range(len(w) - l + 1)) AS i FROM d, ls WHERE len(w) >= l)),
    h AS (SELECT DISTINCT dw.r, dw.i, dw.l, bw.item FROM dw JOIN bw USING (l, said)),
    n AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + l)) AS k FROM h) GROUP BY r),
    t AS (SELECT r, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS s FROM h GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items,
    coalesce(t.s, sha256('')) AS items_sha256, coalesce(n.n_hit, 0) > 0 AND 20 * coalesce(n.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)
"""
