"""Operator 11, phrase collocations: merged count-min sketches before an exact count, then scores and subsumption.

Words are counted exactly first; no phrase is more frequent than its words, so rarer words break their
pieces. What a broadcast table of bits, of fixed size, says of a word can only err towards frequent.

Then texts, equal ones as one with a count, are dealt into groups. A group's sketch has two rows of
counts of its phrases of two words and more, and is sent as the cells it has touched; blocks of cells
add up what all groups send and answer which of these reach the threshold. The sketch grows
with the words (``LOAD``), so the share of phrases passed in vain doesn't. An estimate is never under
the count, so no frequent phrase is lost. Second pass: each group counts the phrases that both rows pass by
their words, and these counts are sent by blocks of hashes and added up exactly.

Scores and subsumption are joins over the frequent phrases, which a table in the shared folder holds; that table
stays, as the result is read from it.

Defined cases: a null or empty text has no words; a null language is ``und``; repeated rows count each;
a very long text is worked on whole, alone in its block; phrases of equal score go by count, then by the
bytes of their words; an empty table gives an empty table of the same columns; the key isn't looked at,
and other columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandseek.llm._exchange import Answers, Questions, answer, ask, block_of, cut, finish, pack_cells, unpack_cells
from strandseek.llm._text import Packed, Shelf, U, chunks, column, mix, utf8
from strandseek.llm.decontam import lower_ascii

LEAST, LONGEST, TOP, SUBSUME = 100, 5, 2000, 100
UNKNOWN = "und"
#: What ends a piece and what ends a word, in the JVM and by byte.
PIECE_ENDS, BETWEEN = b".,;:!?\n\v\f\r", b" \t"
SPLIT = r"[.,;:!?\x0A-\x0D\x20\x09]+"
IS_PIECE_END, IS_BETWEEN = np.zeros(256, bool), np.zeros(256, bool)
IS_PIECE_END[list(PIECE_ENDS)] = True
IS_BETWEEN[list(PIECE_ENDS + BETWEEN)] = True
LOWER = bytes(range(256)).replace(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Bits of the table of frequent words: its size is fixed.
WORD_BITS = 1 << 23
#: Bytes of a group and of a block of its texts; cells of a block; phrases counted to a cell, as a share of the threshold.
GROUP_BYTES, BLOCK, CELLS, LOAD, ROWS = 4 << 20, 1 << 20, 1 << 20, 1 / 8, 2
#: Frequent words to a block of the exact counts.
EXACT_BLOCK = 4 << 20
#: So many languages' word counts are broadcast at most; beyond, they are joined by a shuffle.
LANGUAGES = 10_000


def language_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def in_language(words: np.ndarray, langs: np.ndarray) -> np.ndarray:
    return mix(words ^ langs)


class Texts:
    """A group's texts in lower case, with their languages and how many rows each stands for."""

    def __init__(self, table: pa.Table):
        self.texts = [x.translate(LOWER) for x in utf8(table.column("text").combine_chunks())]
        self.langs = table.column("lang").to_pylist()
        self.copies = table.column("copies").to_numpy()
        known = {x: language_hash(x) for x in set(self.langs)}
        self.lang_hash = np.array([known[x] for x in self.langs], U)


class Phrases:
    """The phrases of a block of texts whose words may all be frequent: hash, first word, number of words."""

    def __init__(self, texts: list[bytes], langs: np.ndarray, frequent: np.ndarray, longest: int):
        p = Packed(texts, IS_BETWEEN)
        words = in_language(p.word_hashes(), langs[p.word_doc])
        ok = frequent[(words >> U(3) & U(WORD_BITS // 8 - 1)).astype(np.int64)] >> (words & U(7)).astype(np.uint8) & 1 == 1
        piece = np.cumsum(IS_PIECE_END[p.buf])[p.word_start] if len(words) else np.zeros(0, np.int64)
        run = np.cumsum(np.concatenate(([True], (piece[1:] != piece[:-1]) | ~ok[1:] | ~ok[:-1])))[: len(words)]
        parts = []
        for n in range(2, longest + 1):
            m = max(len(words) - n + 1, 0)
            at = np.flatnonzero((run[:m] == run[n - 1 : n - 1 + m]) & ok[:m]) if m else np.zeros(0, np.int64)
            parts.append((p.window_hashes(words, n)[at], at, np.full(len(at), n)))
        self.hash, self.at, self.size = (np.concatenate([x[k] for x in parts]) for k in range(3))
        self.p, self.doc = p, p.word_doc[self.at]

    def written(self, which: np.ndarray) -> pa.Array:
        """The words of some phrases, a space between."""
        p = self.p
        size = p.word_end - p.word_start
        until = np.cumsum(size + 1) - 1
        packed = np.full(int(until[-1]) + 1 if len(until) else 0, 0x20, np.uint8)
        mark = np.ones(len(packed), bool)
        mark[until] = False
        packed[mark] = p.buf[~IS_BETWEEN[p.buf]]
        begin, end = (until - size)[self.at[which]], until[self.at[which] + self.size[which] - 1]
        edge = np.concatenate((np.zeros(1, np.int64), np.cumsum(end - begin)))
        places = np.repeat(begin - edge[:-1], end - begin) + np.arange(int(edge[-1]))
        return pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(edge), pa.py_buffer(packed[places]))


def cells_of(h: np.ndarray, row: int, blocks: int) -> np.ndarray:
    """The cell of each phrase in a row of the sketch: block number * CELLS + cell."""
    r = mix(h ^ U(0xA24BAED4963EE407 * (row + 1) & (1 << 64) - 1))
    return block_of(r, blocks) * U(CELLS) + (r & U(CELLS - 1))


def counter(least: int) -> np.dtype:
    """What holds a cell's count up to the threshold."""
    return np.dtype(np.uint8 if least < 256 else np.uint32)


def sketch(h: np.ndarray, n: np.ndarray, blocks: int, least: int) -> Questions:
    """A group's own sketch, as the cells that its phrases touch and what they count, up to the threshold."""
    out, bits = [], U(least.bit_length())
    for row in range(ROWS):
        key = np.sort(cells_of(h, row, blocks) << bits | np.minimum(n, least).astype(U))  # a cell above, a count below
        cell = key >> bits
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), cell[1:] != cell[:-1])))
        count = np.add.reduceat((key & ((U(1) << bits) - U(1))).astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
        cell, count = cell[first], np.minimum(count, least).astype(counter(least))
        out += [(row, k, pack_cells(cell[a:b] - U(k * CELLS)) + count[a:b].tobytes()) for k, a, b in cut(cell // U(CELLS))]
    return out


def passed(h: np.ndarray, said: Answers, blocks: int) -> np.ndarray:
    """The phrases whose cells reach the threshold in all rows of the merged sketch."""
    at = np.arange(len(h))
    for row in range(ROWS):
        held = [unpack_cells(x) + U(k * CELLS) for (r, k), x in sorted(said.items()) if r == row]
        there = np.concatenate(held or [np.zeros(0, U)])
        if not len(there):
            return at[:0]
        cell = cells_of(h[at], row, blocks)
        at = at[there[np.minimum(np.searchsorted(there, cell), len(there) - 1)] == cell]
    return at


def merge_sketches(least: int) -> Callable[[int, list[bytes]], list[bytes]]:
    """Adds up the sketches of one block and answers which of a group's cells reach the threshold."""
    kind = counter(least)

    def merge(_: int, payloads: list[bytes]) -> list[bytes]:
        count, parts = np.zeros(CELLS, np.int64), []
        for data in payloads:
            cells = unpack_cells(data).astype(np.int64)
            if len(cells):
                count[cells] += np.frombuffer(data, kind, offset=len(data) - kind.itemsize * len(cells)).astype(np.int64)
            parts.append(cells.astype(np.uint32))
        return [pack_cells(cells[count[cells] >= least].astype(U)) for cells in parts]

    return merge


def written_counts(counts: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, counts.schema) as writer:
        writer.write_table(counts)
    return out.getvalue().to_pybytes()


def merge_counts(least: int) -> Callable[[pa.Table], pa.Table]:
    """Adds up the exact counts of one block's phrases; only frequent ones are returned."""

    def merge(table: pa.Table) -> pa.Table:
        every = pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in table.column("payload")])
        total = every.group_by(["lang", "phrase"]).aggregate([("f", "sum")])
        total = total.filter(pc.greater_equal(total.column("f_sum"), least))
        return pa.table({"lang": total.column("lang"), "phrase": total.column("phrase").cast(pa.string()), "f": total.column("f_sum")})

    return merge


def frequent_words(words: DataFrame) -> np.ndarray:
    """The table of bits for words of (lang, word): at most ``WORD_BITS`` numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = np.array([language_hash(x) for x in b.column(0).to_pylist()], U)
            h = in_language(Packed(utf8(b.column(1)), IS_BETWEEN).word_hashes(), langs) & U(WORD_BITS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(h).astype(np.int32))], names=["bit"])

    bits = np.zeros(WORD_BITS, bool)
    bits[words.select("lang", "word").mapInArrow(run, "bit int").distinct().toArrow().column(0).to_numpy()] = True
    return np.packbits(bits, bitorder="little")


def frequent_phrases(rows: DataFrame, bits: np.ndarray, n_words: int, n_bytes: int, least: int, longest: int, group_bytes: int) -> DataFrame:
    """lang, phrase, f of the phrases of two words and more that occur so often; ``rows``: lang, text; ``n_words``: of frequent words."""
    blocks, exact_blocks = int(n_words * (longest - 1) / max(1.0, least * LOAD)) // CELLS + 1, n_words // EXACT_BLOCK + 1
    groups = rows.groupBy("lang", "text").agg(F.count(F.lit(1)).alias("copies"))
    groups = groups.select(F.pmod(F.xxhash64("lang", "text"), F.lit(-(-n_bytes // group_bytes) or 1)).alias("group"), "lang", "text", "copies")
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def each(t: Texts) -> Iterator[tuple[int, Phrases]]:
        for a, b in chunks(t.texts, BLOCK):
            yield a, Phrases(t.texts[a:b], t.lang_hash[a:b], shared.value, longest)

    def questions(t: Texts, _: Answers) -> Questions:
        parts = list(each(t))
        h, n = np.concatenate([np.zeros(0, U), *(x.hash for _, x in parts)]), np.concatenate([np.zeros(0, np.int64), *(t.copies[a + x.doc] for a, x in parts)])
        return sketch(h, n, blocks, least)

    def count(t: Texts, said: Answers) -> pa.Table:
        """The exact counts of the group's phrases that pass, by blocks of their hashes, a row a block."""
        names, found = pa.array(t.langs, pa.string()), []
        for a, x in each(t):
            which = passed(x.hash, said, blocks)
            doc = a + x.doc[which]
            found.append(pa.table({"block": pa.array(block_of(x.hash[which], exact_blocks).astype(np.int64)), "lang": names.take(pa.array(doc)), "phrase": x.written(which), "f": pa.array(t.copies[doc], pa.int64())}))
        if not found:
            return pa.table({"block": pa.array([], pa.int64()), "payload": pa.array([], pa.binary())})
        total = pa.concat_tables(found).group_by(["block", "lang", "phrase"]).aggregate([("f", "sum")]).rename_columns(["block", "lang", "phrase", "f"]).sort_by("block")
        runs = cut(total.column("block").to_numpy())
        return pa.table({"block": pa.array([k for k, _, _ in runs], pa.int64()), "payload": pa.array([written_counts(total.slice(i, j - i).drop_columns("block")) for _, i, j in runs], pa.binary())})

    answers = answer(ask(groups, questions, rows=Texts), merge_sketches(least))
    exact = finish(groups, answers, count, "block long, payload binary", rows=Texts)
    return exact.groupBy("block").applyInArrow(merge_counts(least), "lang string, phrase string, f long")


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, size, a, l, r, n and score of every phrase of two words and more, by its lowest-scoring cut."""
    long = counts.withColumn("words", F.split("phrase", " ")).withColumn("size", F.size("words")).where("size > 1")
    cuts = long.select("lang", "phrase", "size", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "size", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("front"), F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"))
    side = lambda name, n: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(n))
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    cuts = cuts.join(side("front", "l"), ["lang", "front"]).join(side("rest", "r"), ["lang", "rest"])
    cuts = cuts.join(F.broadcast(totals) if totals.count() <= LANGUAGES else totals, "lang")
    cuts = cuts.withColumns({"up": F.lit(1000).cast("decimal(4,0)") * exact["a"] * exact["n"], "down": exact["l"] * exact["r"]}).withColumn("score", F.expr("up div down"))
    best = cuts.groupBy("lang", "phrase", "size", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "size", "a", "best.l", "best.r", "n", "best.score")


def parts_within(counts: DataFrame) -> DataFrame:
    """lang, phrase, longer: the most frequent longer phrase around each phrase of two words and more."""
    long = counts.withColumn("words", F.split("phrase", " ")).withColumn("size", F.size("words")).where("size > 2")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.array_join(F.slice("words", i, m), " "))))
    return long.select("lang", "f", F.explode(F.array_distinct(inner)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP, subsume: int = SUBSUME, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: each language's ``top`` phrases that no longer one subsumes."""
    shelf = Shelf(docs.sparkSession, "collocations")
    rows = docs.select(F.coalesce(column(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), column(text).cast("string").alias("text")).where(F.col("text").isNotNull())
    counted = rows.select("lang", F.explode(F.split(lower_ascii(F.col("text")), SPLIT)).alias("word")).where("word != ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    words = shelf.put(counted.groupBy("lang", F.when(F.col("n") >= least, F.col("word")).alias("word")).agg(F.sum("n").alias("n")))  # rare words are one row a language
    totals, frequent = words.groupBy("lang").agg(F.sum("n").alias("n")), words.where("word is not null")
    n_words, n_bytes = (x or 0 for x in (frequent.agg(F.sum("n")).first()[0], rows.agg(F.sum(F.octet_length("text"))).first()[0]))
    long = frequent_phrases(rows, frequent_words(frequent), n_words, n_bytes, least, longest, group_bytes)
    counts = shelf.put(frequent.select("lang", F.col("word").alias("phrase"), F.col("n").alias("f")).unionByName(long))
    kept = scored(counts, totals).join(parts_within(counts), ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < subsume * F.col("a")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return kept.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same in SQL.
COLLOCATIONS_SQL = r"""
WITH p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT coalesce(lang, 'und') AS lang,
        unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL)),
    g AS (SELECT lang, m, array_to_string(w[i + 1 : i + m], ' ') AS phrase FROM (SELECT lang, w, m, unnest(range(len(w) - m + 1)) AS i FROM p, (VALUES (1), (2), (3), (4), (5)) v(m) WHERE len(w) >= m)),
    n AS (SELECT lang, count(*) AS n FROM g WHERE m = 1 GROUP BY lang),
    f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY lang, m, phrase HAVING count(*) >= 100),
    c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
    k AS (SELECT lang, m, phrase, a, array_to_string(w[1 : k], ' ') AS front, array_to_string(w[k + 1 : m], ' ') AS rest, k FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
    s AS (SELECT k.lang, k.phrase, a, k, l.f AS l, r.f AS r, n, (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score FROM k JOIN n USING (lang)
        JOIN f l ON l.lang = k.lang AND l.phrase = front JOIN f r ON r.lang = k.lang AND r.phrase = rest),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    x AS (SELECT lang, array_to_string(w[i : i + j - 1], ' ') AS phrase, max(a) AS longer FROM (SELECT lang, w, a, m, j, unnest(range(1, m - j + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS j FROM c)) GROUP BY ALL),
    o AS (SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b LEFT JOIN x USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM o WHERE rank <= 2000
"""
