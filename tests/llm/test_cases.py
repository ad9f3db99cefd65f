"""The cases that every operator and stage defines: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strandseek.llm import collocations, compression, decontam, language, near_dup, pieces, quality, resampling, secret_scan, substring, suffixes, warc
from strandseek.llm.queries import tokenizer
from strandseek.llm.tokens import token_counts

pytest.importorskip("public_tokenizers")
#: Names that operators use inside, or that need care.
NAMES = ["its_key", "its_digest", "its_class", "its_row", "node", "digest", "row", "class", "group", "bucket", "pieces", "made", "held_out", "a.b", "n_words", "kept", "print"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)


def long_text(size=5_000_000):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))) for _ in range(50_000)]
    out, n = [], 0
    while n < size:
        out.append(rng.choice(words))
        n += len(out[-1]) + 1
    return " ".join(out)


LONG = long_text()
SAME = " ".join(f"the{i} and{i}" for i in range(60))
ROWS = [(1, SAME, "en"), (1, SAME, "en"), (None, SAME, None), (2, None, "en"), (3, "", "de"), (4, " \n\t", None), (5, LONG, "en"), (None, None, None), (6, "der und die das", "de"), (7, SAME + " more", "en"), (7, "other words", "en")]
ITEMS = [("i", SAME), (None, None), ("e", "")]


def docs_of(spark, rows=ROWS):
    full = [(k, t, lang, None, None if t is None else len(t), *["x" if i % 2 else None for i, _ in enumerate(NAMES)]) for k, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA)


def pages_of(docs):
    return docs.select(F.col("doc_id").alias("page_id"), F.col("lang").alias("url"), F.col("text").alias("html"), *[F.col(f"`{n}`") for n in NAMES])


def items_of(spark):
    return spark.createDataFrame(ITEMS, "item_id string, text string")


OPERATORS = {
    "tokens": lambda spark, d, _: token_counts(d, tokenizer("byte_bpe_50k.json")),
    "substring": lambda spark, d, _: substring.dedup(d),
    "decontam": lambda spark, d, _: decontam.decontaminate(d, items_of(spark)),
    "suffixes": lambda spark, d, _: suffixes.dedup(d),
    "warc": lambda spark, d, tmp: warc.read_archives(spark, warc.write_archives(pages_of(d), f"file://{tmp}/w")).withColumnRenamed("page_id", "doc_id"),
    "secrets": lambda spark, d, _: secret_scan.scan(d),
    "pieces": lambda spark, d, _: pieces.round_trips(d, tokenizer("piece_bpe_32k.model")),
    "near": lambda spark, d, _: near_dup.near_classes(d),
    "quality": lambda spark, d, _: quality.quality(d),
    "language": lambda spark, d, _: language.predict(d, language.learn(d)),
    "compression": lambda spark, d, _: compression.score(d, compression.learn(d, spark.createDataFrame([(1, 1), (5, 0), (7, None), (None, 1)], "doc_id long, quality int"))),
    "resampling": lambda spark, d, _: resampling.resample(d, items_of(spark)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operator(spark, tmp_path, name):
    """A row in, a row out, whatever the rows hold; equal rows get equal results; an empty table keeps the columns."""
    got = OPERATORS[name](spark, docs_of(spark), tmp_path)
    rows = got.collect()
    assert sorted(r["doc_id"] or 0 for r in rows) == sorted(k or 0 for k, *_ in ROWS)
    ones = [r for r in rows if r["doc_id"] == 1]
    assert len(ones) == 2 and (ones[0] == ones[1] or name in ("near", "resampling"))  # these tell a group's rows apart
    none = OPERATORS[name](spark, docs_of(spark).limit(0), tmp_path / "none")
    assert none.columns == got.columns and none.count() == 0


def test_values(spark, tmp_path):
    """What the cases are defined to give."""
    d = docs_of(spark)
    of = lambda name: {(r["doc_id"], k): r for k, r in enumerate(sorted(OPERATORS[name](spark, d, tmp_path).collect(), key=lambda r: r["doc_id"] or 0)) if r["doc_id"]}
    by = lambda name: {k: r for (k, _), r in of(name).items()}
    n = len(LONG.split())
    assert by("tokens")[5]["n_bytes"] == len(LONG) and by("tokens")[2]["n_tokens"] == by("tokens")[3]["n_tokens"] == 0
    sub = by("substring")
    assert sub[5]["n_words"] == n and sub[5]["n_removed"] == 0 and sub[2]["n_words"] == 0 and sub[1]["n_removed"] == 0 and sub[2]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    dec = by("decontam")
    assert dec[1]["n_hit"] == 120 and dec[1]["contaminated"] and dec[5]["n_words"] == n and not dec[5]["n_hit"] and dec[3]["n_words"] == 0 and not dec[2]["contaminated"]
    suf = by("suffixes")
    assert suf[1]["n_removed"] == len(SAME) and suf[5]["n_removed"] == 0 and suf[5]["n_bytes"] == len(LONG) and suf[2]["n_bytes"] == 0
    assert by("secrets")[2]["spans"] == "" == by("secrets")[5]["spans"]
    assert by("pieces")[5]["round_trip"] and by("pieces")[2]["n_pieces"] == 0
    near = by("near")
    assert near[1]["class_id"] == 1
    assert near[5]["class_id"] == 5 and near[2]["class_id"] == 2 and near[4]["class_id"] == 4
    assert by("quality")[5]["n_words"] == n and not by("quality")[2]["kept"] and not by("quality")[4]["kept"]
    assert by("language")[2]["lang_pred"] == by("language")[4]["lang_pred"] == "und" and by("language")[5]["score"] >= 0


def test_collocations(spark):
    """Languages and texts of all kinds: counts cover the long text, copies count each, nothing else is there."""
    d = docs_of(spark)
    got = {(r["lang"], r["phrase"]): r for r in collocations.collocations(d, least=2).collect()}
    words = LONG.split()
    pair = next(p for (lang, p) in got if lang == "en" and len(p.split()) == 2 and not p.startswith("the"))
    a, b = pair.split()
    assert got["en", pair]["a"] == sum(x == a and y == b for x, y in zip(words, words[1:], strict=False))
    assert got["en", pair]["n"] == len(words) + 3 * 120 + 1 + 2 and all(lang != "und" for lang, _ in got)
    none = collocations.collocations(d.limit(0))
    assert none.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and none.count() == 0


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_stage(spark, tmp_path, number):
    """Every stage takes such a table, keeps all columns, and takes an empty one."""
    sf = str(tmp_path)
    items_of(spark).write.parquet(f"{sf}/benchmark.parquet")
    _, stage = corpus_pipeline.STAGES[number]
    last = number == len(corpus_pipeline.STAGES) - 1
    d = docs_of(spark)
    out = stage(spark, d, sf)
    rows = out.collect()
    assert out.columns[: len(d.columns)] == d.columns and (last or out.columns == d.columns)
    ids = sorted(r["doc_id"] for r in rows if r["doc_id"] is not None)
    want = {0: [1, 1, 5, 6, 7, 7], 1: [1, 2, 3, 4, 5, 6, 7], 2: [2, 3, 4, 5, 6, 7], 3: [1, 1, 2, 3, 4, 5, 6, 7, 7], 4: [1, 1, 2, 3, 4, 5, 6, 7, 7]}[number]
    assert ids == want
    assert {r["text"] for r in rows if r["doc_id"] == 5} == {LONG}
    none = stage(spark, d.limit(0), sf)
    assert none.columns == out.columns and none.count() == 0
    if last:
        assert [c for c in out.columns if c not in d.columns] == ["pieces_", "n_pieces", "round_trip"] and all(r["round_trip"] for r in rows)
        assert all((r["pieces_"] is None) == (r["text"] is None) for r in rows)


def test_no_local_fallback(spark, monkeypatch):
    """Away from one machine a folder that isn't shared is refused."""
    from strandseek.llm import _text

    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda *_: None)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        _text.shared_folder(Cluster)
    assert re.match("file:|/", _text.shared_folder(spark))
