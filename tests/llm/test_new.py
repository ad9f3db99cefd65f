"""Collocations, the compression classifier and importance resampling, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandseek.llm import collocations, compression, resampling

COLUMNS = "doc_id long, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# collocations


def phrases_by_hand(rows, least, longest, top, subsume):
    n, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\v\f\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i : i + m])] += 1
    found = []
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        score, k = min(((1000 * a * n[lang]) // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        inside = any(g == lang and len(q) > len(p) and c >= least and 100 * c >= subsume * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (g, q), c in f.items())
        if not inside:
            found.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out, place = set(), Counter()
    for lang, score, a, p, left, right in sorted(found):
        place[lang] += 1
        if place[lang] <= top:
            out.add((lang, place[lang], p.decode(), -a, left, right, n[lang], -score))
    return out


def phrase_rows(count=120):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(12)] + ["É", "New", "York", "city"]
    rows = []
    for k in range(count):
        out = []
        for _ in range(rng.randrange(60)):
            out.append(rng.choice(["New York city", "New York", rng.choice(words), rng.choice(words)]))
            if rng.random() < 0.15:
                out.append(rng.choice([".", "\n", ", ", "\t", "!?"]))
        rows.append((k, " ".join(out), rng.choice(["en", "de", None])))
    return [*rows, *rows[:10], (None, None, "en"), (None, "", None), (7, "a.b " * 5, "xx")]


@pytest.mark.parametrize("group_bytes, top, subsume", [(4 << 20, 2000, 100), (900, 5, 100), (900, 2000, 40)])
def test_collocations(spark, group_bytes, top, subsume):
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, COLUMNS).withColumns({c: F.lit("x") for c in ("phrase", "group", "copies", "f")})
    got = collocations.collocations(docs, least=8, top=top, subsume=subsume, group_bytes=group_bytes)
    want = phrases_by_hand(rows, 8, 5, top, subsume)
    assert {tuple(r) for r in got.collect()} == want and len(want) > 10
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_collocations_of_copies(spark):
    """Many equal rows are one text with a count; a phrase with a great count is exact."""
    docs = spark.range(20_000).select(F.lit(1).alias("doc_id"), F.lit("alpha beta gamma").alias("text"), F.lit("en").alias("lang"))
    got = {r["phrase"]: r["a"] for r in collocations.collocations(docs).collect()}
    assert got == {"alpha beta gamma": 20_000}


def test_merged_sketch_never_underestimates():
    rng = np.random.default_rng(1)
    groups = [(rng.integers(0, 2**64, 4000, dtype=np.uint64), rng.integers(1, 4, 4000)) for _ in range(3)]
    often = rng.integers(0, 2**64, 50, dtype=np.uint64)
    groups = [(np.concatenate((h, np.repeat(often, 2))), np.concatenate((n, np.full(100, 2)))) for h, n in groups]
    asked = [collocations.sketch(h, n, 2, 12) for h, n in groups]
    merge, said = collocations.merge_sketches(12), [{} for _ in groups]
    for key in {x[:2] for g in asked for x in g}:
        mine = [(g, x[2]) for g, part in enumerate(asked) for x in part if x[:2] == key]
        for (g, _), bits in zip(mine, merge(key[0], [x for _, x in mine]), strict=True):
            said[g][key] = bits
    for (h, _), s in zip(groups, said, strict=True):
        kept = set(h[collocations.passed(h, s, 2)].tolist())
        assert set(often.tolist()) <= kept and len(kept) < 100


# the compression classifier


def labelled(spark, n=500):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmno") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    docs, labels = [], []
    for k in range(n):
        good = rng.random() < 0.7
        text = " ".join(rng.choice(words) + ("" if good else rng.choice(["###", "$$$", "%%%"])) for _ in range(rng.randrange(20, 400)))
        docs.append((k, text, "en"))
        labels.append((k, int(good)))
    return docs, labels


def test_quality_held_out(spark):
    """Rows that learning never saw are told apart, and scores are about the shares they promise."""
    docs, labels = labelled(spark)
    extra = [(None, "x", 1), (3, None, 5)]
    lab = spark.createDataFrame([(k, q, 0) for k, q in labels] + [(k, None, q) for k, _, q in extra] + [(1, 1 - labels[1][1], 0)], "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame([*docs, (None, None, None), (None, "", None), (2, docs[2][1], "de")], COLUMNS).withColumns({"quality": F.lit(9), "block": F.lit("x"), "score": F.lit(1)})
    model = compression.learn(frame, lab)
    got = compression.score(frame, model).collect()
    assert len(got) == len(docs) + 3 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    truth = dict(labels)
    held = [r for r in got if r["held_out"]]
    assert len(held) > 100 and sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    twice = [r for r in got if r["doc_id"] == 2]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert {r["difference"] for r in got if r["doc_id"] is None} == {0.0}
    assert compression.score(frame.limit(0), model).count() == 0


def test_quality_uses_no_held_out_label(spark):
    docs, labels = labelled(spark, 200)
    held = {k for k, _ in labels if zlib.crc32(str(k).encode()) % 3 == 1}
    frame = spark.createDataFrame(docs, COLUMNS)
    one, other = (compression.learn(frame, spark.createDataFrame([(k, 1 - q if flip and k in held else q) for k, q in labels], "doc_id long, quality int")) for flip in (False, True))
    assert one == other


def test_quality_of_one_label(spark):
    docs, labels = labelled(spark, 60)
    frame = spark.createDataFrame(docs, COLUMNS)
    only = spark.createDataFrame([(k, 1) for k, _ in labels], "doc_id long, quality int")
    assert min(r["score"] for r in compression.score(frame, compression.learn(frame, only)).collect()) > 0.99
    assert {r["score"] for r in compression.score(frame, compression.learn(frame, only.limit(0))).collect()} == {0.5}


def test_difference_covers_the_whole_text():
    """What stands at a text's end counts as much as at its beginning."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    say = lambda mark, n: " ".join(rng.choice(words) + mark for _ in range(n)).encode()
    model = compression.Model(compression.trained([say("", 150) for _ in range(400)], 20_000), compression.trained([say("###", 100) for _ in range(400)], 20_000))
    good, bad = say("", 20_000), say("###", 20_000)
    first, last = model.difference(bad + b" " + good), model.difference(good + b" " + bad)
    assert model.difference(good) > 0 > model.difference(bad) and abs(first - last) < 0.2 * (model.difference(good) - model.difference(bad))


# resampling


def resampled_by_hand(docs, target, words=1, buckets=10_000, seed=2024, percent=10, least=20):
    split = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER).encode())
    runs = lambda w: [zlib.crc32(b" ".join(w[i : i + n])) % buckets for n in range(1, words + 1) for i in range(len(w) - n + 1)]
    s, t = Counter(), Counter()
    for _, text, *_ in docs:
        s.update(runs(split(text)))
    for _, text in target:
        t.update(runs(split(text)))
    big_s, big_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for k, text, *_ in docs:
        w = split(text)
        f = runs(w)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t))) for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        out.append([k, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= least])
    order = sorted((x for x in out if x[4]), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1]))
    drawn = len(order) * percent // 100
    return sorted((*x[:4], r) for x, r in [*((x, n + 1 if n < drawn else -1) for n, x in enumerate(order)), *((x, -1) for x in out if not x[4])] for x in [tuple(-1 if v is None else v for v in x)])


@pytest.mark.parametrize("words, percent", [(1, 10), (2, 35), (3, 100)])
def test_resampling(spark, words, percent):
    rng = random.Random(words)
    said = [*(f"w{k}" for k in range(60)), "Ünï", "É9", "x" * 150]
    text = lambda n: rng.choice([" ", ", ", "-\n"]).join(rng.choice(said) for _ in range(n))
    docs = [(k, text(rng.randrange(60)), "en") for k in range(200)]
    docs += [docs[0]] * 5 + [(None, text(30), None), (None, None, "en"), (4, "", "en"), (9, docs[9][1] + " more", "en")]
    target = [("a", text(90)), ("b", None), (None, "w1 w2 w3")]
    frame = spark.createDataFrame(docs, COLUMNS).withColumns({c: F.lit("x") for c in ("score", "rank", "copies", "fit", "part")})
    got = resampling.resample(frame, spark.createDataFrame(target, "item_id string, text string"), words=words, percent=percent).collect()
    assert sorted(tuple(-1 if v is None else v for v in r) for r in got) == resampled_by_hand(docs, target, words, percent=percent)


def test_resampling_edges(spark):
    docs = spark.createDataFrame([], COLUMNS)
    items = spark.createDataFrame([], "item_id string, text string")
    assert resampling.resample(docs, items).columns == ["doc_id", "n_features", "weight", "score", "rank"] and resampling.resample(docs, items).count() == 0
    copies = spark.range(1000).select(F.lit(3).alias("doc_id"), F.lit("word " * 25).alias("text"))  # one key holds all rows
    got = resampling.resample(copies, items).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 101)) and len(got) == 1000
    assert sorted(r["rank"] for r in resampling.draw(copies, items).collect()) == list(range(1, 101))


def test_copies_are_written_in_parts(spark, monkeypatch):
    monkeypatch.setattr(resampling, "COPIES", 7)
    entries = spark.createDataFrame([(5, 1, 30, 0, True, 40), (9, 2, 30, 0, True, 15), (9, 3, 4, 0, False, 8)], "score long, doc_id long, n_features long, weight long, fit boolean, copies long")
    got = [(r["doc_id"], r["rank"]) for r in resampling.ranked(entries, 50).collect()]
    assert sorted(r for k, r in got if r) == list(range(1, 28)) and Counter(k for k, _ in got) == {1: 40, 2: 15, 3: 8}
    assert {r for k, r in got if k == 2} == set(range(1, 16))


def test_crc32_of_all_lengths():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    begin = np.array([0, 0, 5, 17, 100, 1, 4000, 64])
    end = np.array([0, 1, 69, 81, 4000, 130, 5000, 193])
    assert resampling.crc32(data, begin, end).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(begin, end, strict=True)]
    assert len(resampling.crc32(data, begin[:0], end[:0])) == 0


def test_words_end_where_texts_do():
    f = resampling.Features(pa.array(["skip", "ab", "cd ef", None, "", "gh"]).slice(1), 1, 1 << 20)
    assert f.n_words.tolist() == [1, 2, 0, 0, 1]
    assert sorted(f.bucket.tolist()) == sorted(zlib.crc32(w) % (1 << 20) for w in (b"ab", b"cd", b"ef", b"gh"))


# what changed in the older operators


def test_many_labels(spark, monkeypatch):
    """More labels than are held at once are compared block by block, with the same results."""
    from strandseek.llm import language

    rng = random.Random(4)
    rows = [(k, " ".join("".join(rng.choice("abcdefghij"[k % 7 :]) for _ in range(4)) for _ in range(20)), f"l{k % 7}") for k in range(60)]
    docs = spark.createDataFrame([*rows, (99, None, "x"), (98, "12", "x")], COLUMNS)
    few, many = language.learn(docs), language.learn(docs, languages=2)
    assert isinstance(many, language.Stored) and many.blocks > 1 and isinstance(few, dict)
    assert sorted(map(tuple, language.predict(docs, few).collect())) == sorted(map(tuple, language.predict(docs, many).collect()))
    assert sorted(r["doc_id"] for r in language.keep_known(docs, many).collect()) == [k for k, *_ in rows]


def test_random_spans_by_hand(spark):
    """All tokens are counted, a token is found if its p-value is small enough among them, and none overlaps a base span."""
    from strandseek.llm import secret_scan as scan

    rng = random.Random(6)
    token = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    camel = lambda: "".join(rng.choice(["Get", "Set", "User", "Name", "Item2", "List", "Value", "Of"]) for _ in range(8))
    texts = [f"{camel()} and {camel()} with {token(40) if k % 3 == 0 else camel()}" for k in range(90)] + [f"token = {token(40)} {token(48)}", "", None]
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], COLUMNS)
    held = {k: [] for k in range(len(scan.LENGTHS))}
    per_text = []
    for t in texts:
        mine, base = [], [(a, b) for a, _, b in scan.base_spans(t or "")]
        for m in re.finditer("[A-Za-z0-9]{20,}", t or ""):
            if any(a < m.end() and m.start() < b for a, b in base) or not re.search("[0-9]", m[0]):
                continue
            _, fits, p = scan.battery(m[0])
            p = p if fits >= scan.REJECT else 1.0
            mine.append((p, m.start(), m.end()))
            held[scan.range_of(len(m[0]))].append(p)
        per_text.append(mine)
    limit = {}
    for k, ps in held.items():
        bins = sorted({scan.bin_of(p) for p in ps})
        ok = [b for b in bins if 10 ** (-b / scan.BINS) <= scan.FALSE_SHARE * sum(scan.bin_of(p) >= b for p in ps) / len(ps)]
        limit[k] = min(ok, default=scan.LAST_BIN + 1) if ps else scan.ALONE[k]
    want = [[(a, b) for p, a, b in mine if scan.bin_of(p) >= limit[scan.range_of(b - a)]] for mine in per_text]
    got = {r["doc_id"]: [tuple(map(int, x.split(":")[1:])) for x in r["spans"].split(",") if x.startswith("random")] for r in scan.scan(docs).collect()}
    assert [got[k] for k in range(len(texts))] == want and sum(map(len, want)) >= 25
    assert scan.limits_of(docs.limit(0).select("text")) == scan.ALONE


def test_ordinary_tokens_are_no_discoveries(spark):
    """Of camel-case names alone about as few pass a p-value as it says, whatever the battery keeps of them."""
    from strandseek.llm import secret_scan as scan

    rng = random.Random(8)
    names = ["".join(rng.choice(["get", "Set", "User", "Name", "Item", "2", "List", "Value", "Of", "By", "Id"]) for _ in range(7)) for _ in range(2000)]
    ps = [p for x in names for p, _, _ in scan.tested(x, [])]
    assert len(ps) > 500 and sum(p <= 0.1 for p in ps) <= 0.12 * len(ps)


def test_long_text_of_secrets():
    import time

    from strandseek.llm import secret_scan as scan

    rng = random.Random(1)
    text = " ".join(f"{rng.getrandbits(128):032x} {rng.getrandbits(100):X}" for _ in range(60_000))
    begun = time.perf_counter()
    spans = scan.secret_spans(text)
    assert sum(k == "hex" for _, k, _ in spans) >= 60_000 and time.perf_counter() - begun < 60


def test_alignment_of_moved_blocks():
    """The quick alignment is the banded one where shingles don't repeat, and never more; long texts take seconds."""
    import time

    from strandseek.llm import near_dup

    rng = np.random.default_rng(3)
    for _ in range(200):
        a = rng.permutation(40)[:30]
        b = np.delete(a, rng.integers(0, 30, 4))
        cut = rng.integers(1, 20)
        b = np.concatenate((b[cut:], b[:cut]))
        band = int(rng.integers(1, 20))
        assert near_dup.labelled_matches(a, b, band) == near_dup.banded_matches(a, b, band)
        x, y = rng.integers(0, 8, 30), rng.integers(0, 8, 28)
        full = near_dup.banded_matches(x, y, band)
        assert near_dup.labelled_matches(x, y, band) <= full
        assert near_dup.banded_matches(x, y, band, full) == full and near_dup.banded_matches(x, y, band, full + 1) <= full
    long = rng.permutation(300_000)
    begun = time.perf_counter()
    assert near_dup.similar(long, np.concatenate((long[10_000:], long[:10_000]))) and not near_dup.similar(long, np.concatenate((long[100_000:], long[:100_000])))
    assert time.perf_counter() - begun < 20
