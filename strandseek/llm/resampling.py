"""Operator 13, importance resampling towards a target: hashed word features counted by a byte automaton.

Texts are read as the byte buffers of their Arrow column. A lookup table puts A-Z in lower case and
another tells the bytes of words from others; words begin and end where neighbours differ or a text
does. Separators then shrink to one space, so every run of consecutive words is a range of bytes, and
the CRC-32 of all ranges is advanced together, a byte a step, by its table of 256. Ranges of more than
``SLICE`` bytes are cut into slices that advance together too and are joined afterwards: the register
is linear, so a slice's effect is the earlier register moved on by its length, by table, and added.

Two passes go over the texts: one adds up each bucket's features, one sums each document's gains.
Between them only counts by bucket are gathered, whose number is a parameter. The second pass writes a
narrow table of counted entries to the shared folder, so that no third one is needed. The scores are whole
numbers with a spread that their noise gives them, at most a few of 10,000 documents to one score; so
documents are ranked by how many have a greater score, and among those of one score by a window. Rows
of one key and score are one entry with a count until they are ranked.

Defined cases: a null or empty text has no words, weight 0, and is never drawn; a null key reads as an
empty string in the draw, stays null, and counts as greater than all others where scores tie; repeated
rows are ranked one after the other; rows of equal score and key go by the number of their features; a
very long text is alone in its part and its words may have any length; an empty target or table has no
features, and an empty table gives an empty table of the same columns; other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandseek.llm._text import PART, Shelf, column, ranges

BUCKETS, WORDS, SEED, PERCENT, LEAST = 10_000, 1, 2024, 10, 20
#: Bytes of a range whose registers advance in one go; longer ones are cut.
SLICE = 64
#: Entries of one row of a count that are written out at a time.
COPIES = 100_000
SPACE = 0x20


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    return table


def word_table() -> np.ndarray:
    """Digits, small letters and all bytes beyond ASCII belong to words."""
    table = np.zeros(256, bool)
    table[0x30:0x3A] = table[0x61:0x7B] = table[0x80:] = True
    return table


def crc_table() -> np.ndarray:
    """The effect of each byte on the register, for the reflected polynomial of CRC-32."""
    at = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        at = np.where(at & 1, at >> np.uint32(1) ^ np.uint32(0xEDB88320), at >> np.uint32(1)).astype(np.uint32)
    return at


LOWER, WORD, CRC = lower_table(), word_table(), crc_table()


def step(register: np.ndarray, data: np.ndarray) -> np.ndarray:
    return CRC[(register ^ data) & np.uint32(0xFF)] ^ (register >> np.uint32(8))


def moved(by: int) -> np.ndarray:
    """Four tables, one for each byte of a register, of what ``by`` zero bytes make of it."""
    register = (np.arange(256, dtype=np.uint32)[None, :] << (np.uint32(8) * np.arange(4, dtype=np.uint32))[:, None]).reshape(-1)
    for _ in range(by):
        register = step(register, np.zeros(len(register), np.uint8))
    return register.reshape(4, 256)


MOVED = moved(SLICE)


def advanced(data: np.ndarray, begin: np.ndarray, size: np.ndarray, register: np.ndarray) -> np.ndarray:
    """The registers after the bytes of each range, none longer than ``SLICE``; all advance together."""
    order = np.argsort(-size, kind="stable")
    at, register, left = begin[order], register[order].copy(), size[order]
    on = np.searchsorted(-left, -np.arange(1, int(left[0]) + 1 if len(left) else 1), side="right")  # how many have so many bytes
    for k, n in enumerate(on.tolist()):
        register[:n] = step(register[:n], data[at[:n] + k])
    out = np.empty_like(register)
    out[order] = register
    return out


def crc32(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each range of bytes."""
    size = end - begin
    slices = np.maximum(-(-size // SLICE), 1)
    first = np.cumsum(slices) - slices
    of = np.repeat(np.arange(len(size)), slices)
    number = np.arange(len(of)) - first[of]
    head = size - (slices - 1) * SLICE  # the first slice is the short one
    start = np.where(number == 0, begin[of], begin[of] + head[of] + (number - 1) * SLICE)
    part = advanced(data, start, np.where(number == 0, head[of], SLICE), np.where(number == 0, np.uint32(0xFFFFFFFF), np.uint32(0)).astype(np.uint32))
    register = part[first] if len(size) else np.zeros(0, np.uint32)
    long = np.flatnonzero(slices > 1)
    long = long[np.argsort(-slices[long], kind="stable")]
    on = np.searchsorted(-slices[long], -np.arange(2, int(slices[long[0]]) + 1 if len(long) else 2), side="right")
    for k, n in enumerate(on.tolist(), 1):
        r = register[long[:n]]
        shifted = MOVED[0][r & np.uint32(0xFF)] ^ MOVED[1][r >> np.uint32(8) & np.uint32(0xFF)] ^ MOVED[2][r >> np.uint32(16) & np.uint32(0xFF)] ^ MOVED[3][r >> np.uint32(24)]
        register[long[:n]] = shifted ^ part[first[long[:n]] + k]
    return register ^ np.uint32(0xFFFFFFFF)


class Features:
    """The runs of 1 to ``words`` consecutive words of each text of an Arrow column, as buckets."""

    def __init__(self, texts: pa.Array, words: int, buckets: int):
        texts = texts.fill_null("").cast(pa.large_binary())
        _, places, held = texts.buffers()
        edge = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        base = int(edge[0])
        data = LOWER[np.frombuffer(held, np.uint8)[base : int(edge[-1])]] if held is not None and held.size else np.zeros(0, np.uint8)
        edge = edge - base
        inside = WORD[data]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        stops = inside.copy()
        stops[:-1] &= ~inside[1:]
        inner = edge[(edge > 0) & (edge < len(data))]  # a word ends where its text does
        starts[inner] = inside[inner]
        stops[inner - 1] = inside[inner - 1]
        begin, end = np.flatnonzero(starts), np.flatnonzero(stops) + 1
        first = np.searchsorted(begin, edge)
        self.n_words = np.diff(first)
        if words == 1:
            at, until, doc = begin, end, np.repeat(np.arange(len(texts)), self.n_words)
        else:  # words of a text side by side, one space between
            size = end - begin
            until = np.cumsum(size + 1) - 1
            at = until - size
            packed = np.full(int(until[-1]) + 1 if len(until) else 0, SPACE, np.uint8)
            mark = np.ones(len(packed), bool)
            mark[until] = False
            packed[mark] = data[inside]
            data, last = packed, np.repeat(first[1:], self.n_words)
            place = np.arange(len(at))
            runs = [(place[place + n <= last], n) for n in range(1, words + 1)]
            owner = np.repeat(np.arange(len(texts)), self.n_words)
            doc = np.concatenate([owner[k] for k, _ in runs])
            at, until = np.concatenate([at[k] for k, _ in runs]), np.concatenate([until[k + n - 1] for k, n in runs])
        self.doc, self.n_texts = doc, len(texts)
        self.bucket = (crc32(data, at, until) % np.uint32(buckets)).astype(np.int64)

    def per_text(self, gains: np.ndarray | None = None) -> np.ndarray:
        """How many features each text has, or the sum of their gains."""
        if gains is None:
            return np.bincount(self.doc, minlength=self.n_texts)
        total = np.concatenate((np.zeros(1, np.int64), np.cumsum(gains[self.bucket[np.argsort(self.doc, kind="stable")]])))
        ends = np.cumsum(self.per_text())
        return total[ends] - total[ends - self.per_text()]


def bucket_counts(rows: DataFrame, text: str, words: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket: what comes back is bounded by their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for b in batches:
            for i, j in ranges(b.column(0), PART):
                n += np.bincount(Features(b.column(0).slice(i, j - i), words, buckets).bucket, minlength=buckets)
        there = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(n[there], pa.int64())], names=["bucket", "n"])

    got = rows.select(column(text).cast("string").alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


def learned_gains(docs: DataFrame, target: DataFrame, text: str = "text", words: int = WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain: 1000 times the logarithm of how much likelier it is in the target, with one added to each count."""
    s, t = bucket_counts(docs, text, words, buckets), bucket_counts(target, text, words, buckets)
    up = (t + 1).astype(np.float64) * float(int(s.sum()) + buckets)
    down = (s + 1).astype(np.float64) * float(int(t.sum()) + buckets)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the key alone."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def scored(docs: DataFrame, gains: np.ndarray, key: str = "doc_id", text: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in ranges(b.column(1), PART):
                f = Features(b.column(1).slice(i, j - i), words, buckets)
                n = f.per_text()
                weight = f.per_text(gains) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *(pa.array(x, pa.int64()) for x in (f.n_words, n, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(column(key).cast("long").alias("doc_id"), column(text).cast("string").alias("text"))
    out = rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")
    return out.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT, least: int = LEAST) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; drawn rows have a rank, from 1."""
    rows = scored(docs, learned_gains(docs, target, text, words, buckets), key, text, words, seed)
    entries = rows.groupBy("score", "doc_id", "n_features", "weight", (F.col("n_words") >= least).alias("fit")).agg(F.count(F.lit(1)).alias("copies"))
    return ranked(Shelf(docs.sparkSession, "resampling").put(entries), percent)


def ranked(entries: DataFrame, percent: int) -> DataFrame:
    """The rows that ``entries`` stand for, with the rank of those drawn.

    Weights lie between two logarithms of counts and the noise between two fixed values, so scores are
    whole numbers in a range that no table leaves: counts by score are bounded and may be gathered.
    """
    spark = entries.sparkSession
    by_score = entries.where("fit").groupBy("score").agg(F.sum("copies").alias("n")).orderBy(F.desc("score")).collect()
    draw = sum(r["n"] for r in by_score) * percent // 100
    before, seen = [], 0
    for r in by_score:
        if seen >= draw:
            break
        before.append((r["score"], seen))
        seen += r["n"]
    last = before[-1][0] if before else None  # the lowest score of which some are drawn
    near = F.col("fit") & (F.col("score") >= last) if before else F.lit(False)
    above = F.broadcast(spark.createDataFrame(before, "score long, above long"))
    ahead = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features").rowsBetween(Window.unboundedPreceding, -1)
    drawn = entries.where(near).join(above, "score").withColumn("first", F.col("above") + F.coalesce(F.sum("copies").over(ahead), F.lit(0)) + 1)
    rest = entries.where(~near).withColumn("first", F.lit(None).cast("long"))
    both = drawn.select(*(wanted := ["doc_id", "n_features", "weight", "score", "copies", "first"])).unionByName(rest.select(*wanted))
    many = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES)))
    some = F.explode(F.sequence(F.col("part") * COPIES, F.least(F.col("copies"), (F.col("part") + 1) * COPIES) - 1))
    each = both.withColumn("part", many).withColumn("copy", some)
    rank = F.col("first") + F.col("copy")
    return each.select("doc_id", "n_features", "weight", "score", F.when(rank <= draw, rank).cast("long").alias("rank"))


def draw(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT, least: int = LEAST) -> DataFrame:
    """The keys of the drawn rows in the order of their ranks' numbers: doc_id, rank."""
    return resample(docs, target, key, text, words, buckets, seed, percent, least).where(F.col("rank").isNotNull()).select("doc_id", "rank")


#: The same in SQL: CRC-32 byte by byte over the distinct words.
RESAMPLE_SQL = r"""
WITH crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c FROM range(256) r(i))),
    d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
    ds AS (SELECT r, unnest(w) AS word FROM d),
    bs AS (SELECT unnest(coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])) AS word FROM benchmark),
    v AS (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM ds UNION SELECT word FROM bs)),
    b AS (SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(x) // 2), lambda k: CAST('0x' || substr(x, CAST(2 * k + 1 AS INTEGER), 2) AS BIGINT))),
        lambda s, y: xor(t[CAST((xor(s, y) & 255) + 1 AS INTEGER)], s >> 8)), 4294967295) % 10000 AS bucket FROM v, crc),
    s AS (SELECT bucket, count(*) AS n FROM ds JOIN b USING (word) GROUP BY bucket),
    t AS (SELECT bucket, count(*) AS n FROM bs JOIN b USING (word) GROUP BY bucket),
    a AS (SELECT (SELECT coalesce(sum(n), 0) FROM s)::DOUBLE + 10000 AS big_s, (SELECT coalesce(sum(n), 0) FROM t)::DOUBLE + 10000 AS big_t),
    g AS (SELECT s.bucket, CAST(floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * big_s) / ((s.n + 1)::DOUBLE * big_t))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket), a),
    f AS (SELECT r, count(*) AS n_features, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM ds JOIN b USING (word) JOIN g USING (bucket) GROUP BY r),
    h AS (SELECT r, doc_id, CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d),
    x AS (SELECT r, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM h LEFT JOIN f USING (r)),
    k AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS rank, count(*) OVER () AS n FROM x WHERE n_features >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM x LEFT JOIN k USING (r)
"""
