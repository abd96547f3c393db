"""Each stage of the pipeline against plain Python, from that stage's own input."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from haulage.llm import toxicity
from haulage.llm.queries import tokenizer_path
from haulage.session import scratch_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(12)
    words = ["".join(pick.choices("abcdefgh", k=pick.randint(3, 7))) for _ in range(300)]
    some = lambda n: " ".join(pick.choices(words, k=n))
    texts = [some(pick.randint(1, 60)) for _ in range(60)]
    texts += [texts[3], texts[4] + " more", texts[4].upper(), "", None, " \n", "x <|endoftext|> y"]
    texts += [some(20) + " the quick leaked benchmark passage of some forty characters " + some(9), "vexo " + some(30)]
    made = [(i, t, ("en", "fr", None)[i % 3], ("b", "a", None)[i % 3], len(t or "")) for i, t in enumerate(texts)]
    return [*made, made[2], made[2], (5, "another text of document five " + some(20), "en", "a", 1), (None, texts[6], "en", "a", 1), (None, texts[6], "en", "a", 1)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def tables(spark, rows):
    path = scratch_dir(spark, "stage-tables")
    items = [(1, "the quick leaked benchmark passage of some forty characters"), (2, "no"), (3, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    marks = [(r[0], 0, int((r[1] or "").startswith("vexo"))) for r in rows if r[0] is not None and r[0] % 2 == 0]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def plain(result):
    return Counter(tuple(r) for r in result.select(*SCHEMA.replace(" long", "").replace(" string", "").split(", ")).collect())


def test_toxicity_stage(spark, docs, rows, tables, monkeypatch):
    monkeypatch.setattr(toxicity, "MIN_UPDATES", 20)
    model = toxicity.train(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    import pyarrow as pa

    scores = model.scores(pa.array([r[1] for r in rows], pa.string()))
    kept = Counter(r for r, s in zip(rows, scores, strict=True) if s < model.threshold(r[2]))
    found = corpus_pipeline.drop_toxic(spark, docs, tables)
    assert found.columns == docs.columns and plain(found) == kept


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def test_near_copies_stage(spark, docs, rows, tables):
    sets = [shingles(r[1]) for r in rows]
    of = list(range(len(rows)))

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both, union = len(x & sets[j]), len(x | sets[j])
            if both and 100 * both >= 75 * union and rows[i][0] is not None and rows[j][0] is not None:
                of[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    kept = {(r[0], r[1]) for i, r in enumerate(rows) if r[0] is None or r[0] == least[root(i)]}
    found = corpus_pipeline.drop_near_copies(spark, docs, tables)
    got = [(r.doc_id, r.text) for r in found.collect()]
    assert found.columns == docs.columns and len(got) == len(set(got)) and set(got) == kept


def test_benchmark_stage(spark, docs, rows, tables):
    item = "the quick leaked benchmark passage of some forty characters"
    kept = Counter(r for r in rows if item not in (r[1] or ""))
    found = corpus_pipeline.drop_leaks(spark, docs, tables)
    assert found.columns == docs.columns and plain(found) == kept and sum(kept.values()) == len(rows) - 1


def test_mixing_stage(spark, docs, rows, tables):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += count(r[1])
    weights = {"a": 5, "b": 2, None: 1}
    target, stopped, total = {}, set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        share = sum(w for s, w in weights.items() if s not in stopped)
        target = {s: 3 * sizes[s] if s in stopped else w * left / share for s, w in weights.items()}
        over = {s for s in sizes if s not in stopped and target[s] > 3 * sizes[s]}
        if not over:
            break
        stopped |= over
    kept = Counter()
    for r in rows:
        rate = target[r[3]] / sizes[r[3]]
        name = r[0] if r[0] is not None else "text:" + hashlib.md5((r[1] or "").encode()).hexdigest()
        coin = int(hashlib.md5(f"1:{name}".encode()).hexdigest()[:13], 16) / (1 << 52)
        kept[r] += int(rate) + (coin < rate - int(rate))
    found = corpus_pipeline.mix_sources(spark, docs, tables)
    assert found.columns == docs.columns and plain(found) == +kept


def test_tokens_stage(spark, docs, rows, tables):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(tokenizer_path())
    found = corpus_pipeline.tokenize(spark, docs, tables).collect()
    wanted = Counter()
    for r in rows:
        ids = np.array([*tool.encode(r[1] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        wanted[(r[0], len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == wanted
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_tables_and_other_columns(spark, docs, tables, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    odd = docs.withColumns({x: F.lit(1) for x in ("toxic", "label_id", "node", "copy", "ordinal", "text_hash")})
    assert stage(spark, odd.limit(0), tables).count() == 0
    found = stage(spark, odd, tables)
    assert name == "tokens" or found.columns == odd.columns
