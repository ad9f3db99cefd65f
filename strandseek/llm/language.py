"""Operator 10, language ID: rank-order n-gram profiles compared by out-of-place distance.

Learning counts the letter n-grams of labelled texts and keeps each language's most frequent ones
in order. It may use a bounded sample of the labelled rows: each row is taken or not by a hash of
its key and text, with a rate that makes ``sample`` rows expected (rows that repeat one key and text
are in or out together); everything else covers all rows. A text
is compared by its own most frequent n-grams: each adds the difference of its two ranks, or the
profile's length where the profile lacks it; the nearest profile wins, ties by name.

Defined cases: a null text, or one without letters, is ``und`` with score 0, and teaches nothing if it
is labelled; without any profile every text is ``und``; a null key stays null and is held out of
nothing; n-grams of equal counts rank in code point order; repeated rows give repeated rows, and count
each when learning; a very long text is counted whole, alone in its block; an empty table gives an
empty table of the same columns; other columns, whatever their names, are never looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandseek.llm._text import PART, Shelf, chunks, column, map_texts, only, picked, ranges, text_udf

PROFILE, SAMPLE = 400, 20_000
#: Profiles of so many languages are held at a time; those of more are stored and compared in turn.
LANGUAGES = 1000
UNKNOWN = "und"
#: Texts of about so many bytes are counted at once.
BLOCK = 1 << 19
MARK = "_"


def held_out(key: Column) -> Column:
    """Whether crc32 of the key as text leaves 1 modulo 3; a null key isn't held out."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


class Grams:
    """The letter n-grams (n from 1 to 3) of a block of texts, counted for each owner of texts.

    Letters are numbered in code point order from 2, within the block; 1 is the mark before, between
    and behind words. An n-gram is its numbers side by side, filled up with 0, so the order of n-grams
    is that of their code points. No n-gram spans a mark. Rows are sorted by owner and n-gram.
    """

    def __init__(self, texts: list[str | None], owner: np.ndarray):
        low = [(x or "").lower() for x in texts]
        cps = np.frombuffer(("\n" + "\n".join(low) + "\n").encode("utf-32-le", "replace"), np.uint32)
        mine = np.repeat(owner, [len(x) + 1 for x in low])
        mine = np.concatenate((mine[:1], mine)) if len(mine) else np.zeros(len(cps), np.int64)
        there = np.flatnonzero(np.bincount(cps))
        self.letters = [c for c in there.tolist() if chr(c).isalpha()]
        self.bits = (len(self.letters) + 2).bit_length()
        number = np.ones(int(there[-1]) + 1, np.uint64)
        number[self.letters] = np.arange(2, len(self.letters) + 2)
        code = number[cps]
        keep = code != 1
        keep[0] = True  # the mark before the first text
        keep[1:] |= code[:-1] != 1
        code, mine = code[keep], mine[keep].astype(np.uint64)
        b = self.bits
        self.number = {chr(c): k for k, c in enumerate(self.letters, 2)} | {MARK: 1}
        one, letter = code << np.uint64(2 * b), code != 1
        two = one[:-1] | code[1:] << np.uint64(b)
        three = (two[:-1] | code[2:])[letter[1:-1]]
        keys = np.concatenate((one[letter], two, three))
        owners = np.concatenate((mine[letter], np.where(letter[:-1], mine[:-1], mine[1:]), mine[1:-1][letter[1:-1]]))
        keys |= owners << np.uint64(3 * b)
        keys.sort()
        first = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
        self.count = np.diff(np.append(first, len(keys)))
        self.owner = (keys[first] >> np.uint64(3 * b)).astype(np.int64)
        self.gram = keys[first] & np.uint64((1 << 3 * b) - 1)

    def key(self, gram: str) -> int | None:
        """A written n-gram as a key of this block, if all its letters occur."""
        out = 0
        for k in range(3):
            n = self.number.get(gram[k]) if k < len(gram) else 0
            if n is None:
                return None
            out = out << self.bits | n
        return out

    def written(self, keys: np.ndarray) -> list[str]:
        sign = {k: c for c, k in self.number.items()} | {0: ""}
        part = [((keys >> np.uint64(s * self.bits)) & np.uint64((1 << self.bits) - 1)).tolist() for s in (2, 1, 0)]
        return [sign[x] + sign[y] + sign[z] for x, y, z in zip(*part, strict=True)]

    def ranked(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(owner, place, gram) of each owner's most frequent n-grams, ties by the n-gram."""
        order = np.argsort(self.owner << 40 | (1 << 40) - 1 - self.count, kind="stable")
        owner = self.owner[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        top = place < size
        return owner[top], place[top], self.gram[order][top]


@dataclass
class Stored:
    """The profiles of more languages than are held at once: a table of (lang, gram, place, block), dealt into blocks by a hash of the language."""

    table: DataFrame
    blocks: int

    def block(self, number: int) -> dict[str, list[str]]:
        return as_profiles(self.table.where(F.col("block") == number).select("lang", "gram", "place").collect())


def as_profiles(rows: list) -> dict[str, list[str]]:
    out: dict[str, list] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["place"])):
        out.setdefault(row["lang"], []).append(row["gram"])
    return out


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", size: int = PROFILE, sample: int = SAMPLE, languages: int = LANGUAGES) -> dict[str, list[str]] | Stored:
    """Each language's n-grams in order of frequency, from rows that aren't held out and have a label and a text.

    What reaches the driver is ``size`` n-grams a language, of at most ``languages``; profiles of more stay a table in the shared folder.
    """
    rows = docs.select(column(key).cast("long").alias("doc_id"), column(text).cast("string").alias("text"), column(lang).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    n = rows.select("doc_id").count()
    if n > sample:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < F.lit(int(1_000_000 * sample / n) + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(None)
        total: Counter = Counter()
        for b in batches:
            langs, texts = b.column(1).dictionary_encode(), b.column(0)
            names, owner = langs.dictionary.to_pylist(), langs.indices.to_numpy()
            for i, j in ranges(texts, BLOCK):
                g = Grams(texts.slice(i, j - i).to_pylist(), owner[i:j])
                for k, gram, n in zip(g.owner.tolist(), g.written(g.gram), g.count.tolist(), strict=True):
                    total[names[k], gram] += n
        out = [(lang, g, n) for (lang, g), n in total.items()]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "gram", "n"])

    counts = rows.select("text", "lang").mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("place", place).where(F.col("place") <= size).select("lang", "gram", "place")
    rows = best.limit(size * languages + 1).collect()
    if len(rows) <= size * languages:
        return as_profiles(rows)
    spark = docs.sparkSession
    best = Shelf(spark, "profiles").put(best)
    blocks = best.select("lang").distinct().count() // languages + 1
    return Stored(best.withColumn("block", F.pmod(F.xxhash64("lang"), F.lit(blocks))), blocks)


class Judge:
    """Predicts with learned profiles."""

    def __init__(self, profiles: dict[str, list[str]], size: int = PROFILE):
        self.langs, self.size = sorted(profiles), size
        self.rank: dict[str, list[int]] = {}
        for k, lang in enumerate(self.langs):
            for place, g in enumerate(profiles[lang]):
                self.rank.setdefault(g, [-1] * len(self.langs))[k] = place

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Of each text the language, and how much nearer it is than the next, between 0 and 1."""
        return [self.judged(n, near) for n, near in self.nearest(texts)]

    def nearest(self, texts: list[str | None]) -> list[tuple[int, list[tuple[int, str]]]]:
        """Of each text how many n-grams it has and its nearest two languages with their distances."""
        return [x for i, j in chunks([t or "" for t in texts], BLOCK) for x in self.block(texts[i:j])]

    def block(self, texts: list[str | None]) -> list[tuple[int, list[tuple[int, str]]]]:
        m, size = len(texts), self.size
        g = Grams(texts, np.arange(m))
        owner, place, gram = g.ranked(size)
        grams = np.bincount(owner, minlength=m)
        known = sorted((key, x) for x in self.rank if (key := g.key(x)) is not None)
        table = np.array([key for key, _ in known], np.uint64)
        ranks = np.array([self.rank[x] for _, x in known], np.int64).reshape(len(known), len(self.langs))
        at = np.searchsorted(table, gram)
        found = (at < len(table)) & (table[np.minimum(at, len(table) - 1)] == gram) if len(table) else np.zeros(len(gram), bool)
        far = np.empty((m, len(self.langs)), np.int64)
        for k in range(len(self.langs)):
            step = np.full(len(gram), size)
            r = ranks[at[found], k]
            step[found] = np.where(r >= 0, np.abs(r - place[found]), size)
            far[:, k] = np.bincount(owner, step, m)
        out = []
        for n, x in zip(grams.tolist(), far.tolist(), strict=True):
            near = sorted((d, k) for k, d in enumerate(x))[:2] if n else []
            out.append((n, [(d, self.langs[k]) for d, k in near]))
        return out

    def judged(self, n: int, near: list[tuple[int, str]]) -> tuple[str, float]:
        """The language of a text of n different n-grams, from its nearest two languages and how far they are."""
        if not n or not near:
            return UNKNOWN, 0.0
        rest = near[1][0] if len(near) > 1 else self.size * n
        return near[0][1], 1 - near[0][0] / rest if rest else 0.0


def nearest_of_stored(rows: DataFrame, profiles: Stored, size: int) -> DataFrame:
    """doc_id, lang_pred, score of rows (doc_id, text): block by block of the languages, a written table between, the nearest two so far go along."""
    shelf = Shelf(rows.sparkSession, "languages")
    state = "doc_id long, text string, n int, near array<struct<far: long, lang: string>>"
    rows = rows.select("doc_id", "text", F.lit(0).alias("n"), F.array().cast("array<struct<far: long, lang: string>>").alias("near"))
    for number in range(profiles.blocks):
        judge = Judge(profiles.block(number), size)

        def run(batches: Iterator[pa.RecordBatch], judge: Judge = judge) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i, j in ranges(b.column(1), PART):
                    part = b.slice(i, j - i)
                    found = judge.nearest(part.column(1).to_pylist())
                    before = [[(x["far"], x["lang"]) for x in near] for near in part.column(3).to_pylist()]
                    both = [[{"far": d, "lang": x} for d, x in sorted(old + new)[:2]] for old, (_, new) in zip(before, found, strict=True)]
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([n for n, _ in found], pa.int32()), pa.array(both, b.schema.field(3).type)], schema=b.schema)

        rows = shelf.put(rows.mapInArrow(run, state))
    last = F.col("near")[0]
    rest = F.coalesce(F.get("near", F.lit(1))["far"], F.col("n").cast("long") * size)
    known = (F.col("n") > 0) & (F.size("near") > 0)
    score = F.when(known & (rest > 0), 1 - last["far"] / rest).otherwise(0.0)
    return rows.select("doc_id", F.when(known, last["lang"]).otherwise(UNKNOWN).alias("lang_pred"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)).alias("score"))


def predict(docs: DataFrame, profiles: dict[str, list[str]] | Stored, key: str = "doc_id", text: str = "text", size: int = PROFILE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, from its text alone."""
    if isinstance(profiles, Stored):
        out = nearest_of_stored(picked(docs, key, text), profiles, size)
    else:
        judge = Judge(profiles, size)

        def run(keys: list, texts: list) -> dict[str, list]:
            said = judge(texts)
            return {"doc_id": keys, "lang_pred": [x[0] for x in said], "score": [min(1.0, max(0.0, x[1])) for x in said]}

        out = map_texts(picked(docs, key, text), run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, profiles: dict[str, list[str]] | Stored, text: str = "text", size: int = PROFILE) -> DataFrame:
    """The rows whose text has some language, with all their columns; only ``und`` goes."""
    if isinstance(profiles, Stored):  # with any profile, a text is without language if it has no n-grams
        profiles = next(x for x in map(profiles.block, range(profiles.blocks)) if x)
    judge = Judge(profiles, size)
    known = text_udf(lambda texts: [x != UNKNOWN for x, _ in judge(texts)], "boolean", pa.bool_())
    return docs.where(known(column(text).cast("string")))
