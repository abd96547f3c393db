"""Hard negatives, conversation repair and suffix sorting against plain Python and SQL."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from haulage.llm import negatives, queries, repair, suffixes, tokens

NAN, INF = float("nan"), float("inf")


def in_duck(sql, sf_dir, *tables):
    connection = duckdb.connect()
    for name in tables:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection.execute(sql).fetchall()


def test_negatives_as_sql(spark, sf_dir):
    found = [tuple(r) for r in queries.op11_negatives(spark, sf_dir).collect()]
    assert sorted(found, key=repr) == sorted(in_duck(queries.NEGATIVES, sf_dir, "embeddings"), key=repr) and found


def plain_negatives(rows):
    rows = [(i, v, label) for i, v, label in rows if label is not None and v is not None and all(x is not None and abs(x) < INF for x in v)]
    rows = [(i, [int(np.floor(256 * float(x))) for x in v], label) for i, v, label in rows]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for i, v, label in rows:
        if i is None or i % 10:
            continue
        scored = [(dot(v, w), j, other) for j, w, other in rows]
        best = sorted(((s, j) for s, j, other in scored if other == label and j != i), key=order)[:5]
        for p, j in best:
            band = sorted(((s, k) for s, k, other in scored if other != label and 80 * p <= 100 * s <= 100 * p), key=order)[:5]
            out += [(i, j, rank, k, p, s) for rank, (s, k) in enumerate(band, 1)]
    return sorted(out, key=repr)


def test_negatives_odd_rows(spark, monkeypatch):
    pick = random.Random(4)
    rows = [(i, [pick.choice([-0.5, -0.01, 0.0, 0.3, 1.0]) for _ in range(pick.choice([3, 11]))], pick.choice([0, 0, 0, 1, -7])) for i in range(150)]
    rows += [(10, None, 0), (20, [0.1], None), (30, [NAN, 0.1], 0), (40, [INF], 0), (50, [None, 0.5], 0), (None, [1.0, 1.0], 1), (None, [0.5, 1.0], 0)]
    rows += [rows[0], rows[0], rows[7], rows[7], (-10, [], 0), (-20, [1.0] * 30, 1), (200, [-2.0] * 9, 55)]
    rows += [(300 + i, [0.25] * 8, i % 2) for i in range(40)]  # ties
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    table = table.withColumn("id", F.lit("x")).withColumn("block", F.lit(1)).withColumn("score", F.lit(0)).repartition(5)
    for block in (4096, 16):
        monkeypatch.setattr(negatives, "BLOCK", block)
        monkeypatch.setattr(negatives, "ANCHORS", block)
        found = negatives.hard_negatives(table, F.col("id") % 10 == 0).collect()
        assert sorted((tuple(r) for r in found), key=repr) == plain_negatives(rows)
    assert negatives.hard_negatives(table.limit(0), F.col("id") % 10 == 0).count() == 0
    assert negatives.hard_negatives(table, F.col("id") == -1).count() == 0


def test_four_russians_scores_are_exact():
    random_ = np.random.default_rng(2)
    for low, high in ((-1, 1), (-130, 147), (-(1 << 20), 1 << 20)):
        rows, anchors = random_.integers(low, high, (50, 24)), random_.integers(low, high, (7, 24))
        _, _, bits = negatives.bit_planes(rows)
        assert (negatives.scores(negatives.subset_sums(anchors, np.int64), bits) == rows @ anchors.T).all()
    huge = np.full((1, 8), 1 << 40)
    assert negatives.bit_planes(huge)[0] == 42


NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def all_repairs(rows):
    """(cost, audit, digest) of the cheapest repair, over whole strings of edits."""

    def more(cost, audit, i, state, out):
        if not audit.endswith("III"):
            for role in ("user", "assistant"):
                if role[0] in NEXT[state]:
                    yield cost + 5, audit + "I", i, role[0], (*out, f"{role}:")
        if i < len(rows):
            role, text, what = rows[i]
            yield cost + 2, audit + "D", i + 1, state, out
            extra = 5 if what == "truncated" else 0
            if what not in ("blank", "duplicate"):
                for edit, name, price in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                    if name and name[0] in NEXT[state]:
                        yield cost + price + extra, audit + edit, i + 1, name[0], (*out, f"{name}:{text}")

    heap, ends = [(0, "", 0, "", ())], []
    while heap and not (ends and heap[0][0] > ends[0][0]):
        way = heapq.heappop(heap)
        if way[2] == len(rows) and way[3] in ("", "a"):
            ends.append(way)
        for x in more(*way):
            heapq.heappush(heap, x)
    cost, audit, _, _, out = min(ends)
    return cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def test_repair_search_is_the_cheapest():
    pick = random.Random(3)
    for _ in range(1500):
        rows = [
            (pick.choice(["user", "assistant", "system", "user", "assistant", " ", "", "tool"]), f"t{k}", pick.choice([None, None, None, "blank", "duplicate", "truncated"]))
            for k in range(pick.randint(0, 8))
        ]
        search = repair.Repair()
        for row in rows:
            search.row(*row)
            order = sorted(search.alive.values(), key=lambda x: x[2])
            strings = [repair.edits_of(leaf) for _, leaf, _ in order]
            assert strings == sorted(set(strings))  # the places carried along are those of the whole strings
        assert search.finish() == all_repairs(rows)


@pytest.mark.parametrize("roles, faults, most", [("ua", [None], 8), ("u", ["truncated"], 8), ("sa", ["blank"], 8), ("uaa", [None, None, "truncated", "blank"], 80)])
def test_repair_settles_early(roles, faults, most):
    names = {"u": "user", "a": "assistant", "s": "system"}
    search = repair.Repair()
    for i in range(5000):
        search.row(names[roles[i % len(roles)]], "t.", faults[i * 7 // 3 % len(faults)])
    assert search.most_unsettled <= most


def plain_repair(rows, damage):
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
            role, text = (" " if x is None else x for x in (role, text))
            text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
            role = "user" if fate == 4 else role
            kept += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        seen, what = set(), []
        for _, role, text in kept:
            what.append(repair.fault(text, (role, text) in seen))
            seen.add((role, text))
        turns = {t for t, _, _ in kept if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:])]
        counts = [what.count(x) for x in ("blank", "duplicate", "truncated")]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        out[conv] = (conv, gaps, *counts, illegal, *all_repairs([(r, t, w) for (_, r, t), w in zip(kept, what)]))
    return sorted(out.values(), key=repr)


def test_repair_of_tables(spark):
    pick = random.Random(6)
    texts = ["Hello.", "hello", "What? ", " \t", "", None, "é!", "Yes. \n", "a" * 3000]
    rows = [(c, pick.choice([None, 0, 1, 2, 3, 9]), pick.choice(["user", "assistant", "system", None, "", "tool"]), pick.choice(texts)) for c in [*range(60), None] for _ in range(pick.randint(1, 6))]
    rows += [rows[3], rows[3], rows[9], (70, 5, "user", "Only.")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table = table.withColumns({x: F.lit("x") for x in ("key", "first", "is_row", "of")}).repartition(4)
    found = repair.repair(repair.damaged(table)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == plain_repair(rows, True)
    whole = repair.repair(table.withColumn("times", F.lit(1))).collect()
    assert sorted((tuple(r) for r in whole), key=repr) == plain_repair(rows, False)
    gone = repair.repair(table.withColumn("times", F.lit(0))).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(gone) == 62 and {tuple(r)[1:] for r in gone} == {(0, 0, 0, 0, 0, 0, "", empty)}
    assert repair.repair(repair.damaged(table.limit(0))).count() == 0


def test_repair_query(spark, sf_dir):
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = sorted((tuple(r) for r in queries.op12_repair(spark, sf_dir).collect()), key=repr)
    assert found == plain_repair(rows, True)


def plain_removal(rows, window):
    """Per row doc_id, n_bytes, n_removed, n_spans, digest of the rest."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).digest()[7::-1]))
    order.sort(key=lambda r: (r[0] is None, r[0] or 0, int.from_bytes(hashlib.sha256((r[1] or "").encode()).digest()[:8], "little", signed=True)))
    seen, out = set(), []
    for doc_id, text in order:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for at in range(len(data) - window + 1):
            if data[at : at + window] in seen:
                gone[at : at + window] = True
            seen.add(data[at : at + window])
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def made_documents():
    pick = random.Random(9)
    some = lambda n: "".join(pick.choices("abcdeé \n", k=n))
    passage, line, base = some(150), some(60), some(700)
    texts = [None, "", "short", some(99), "a" * 350, "ab" * 200, passage, f"{passage}{passage}", base, base, base + "x"]
    texts += [f"{some(80)}{passage}{some(n)}" for n in range(0, 60, 5)]
    texts += [f"{some(45)}{line}{some(45)}" for _ in range(30)]
    for _ in range(12):  # near copies
        edited = list(base)
        for _ in range(3):
            edited[pick.randrange(len(edited))] = pick.choice("xyz")
        texts.append("".join(edited))
    rows = [(i, t) for i, t in enumerate(texts)]
    pick.shuffle(rows)
    rows += [(8, base), (8, base), (None, base), (None, None), (20, some(300) + passage), (20, "other " + passage), (-3, passage[20:] + some(30))]
    return rows


@pytest.fixture(scope="module")
def documents(spark):
    table = spark.createDataFrame(made_documents(), "doc_id long, text string")
    return table.withColumns({x: F.lit("x") for x in ("ordinal", "k1", "gram", "n", "place")}).repartition(3).cache()


@pytest.mark.parametrize("most_forms", [4096, 2, 0])
def test_suffixes_as_brute_force(documents, most_forms):
    found = suffixes.remove_repeated(documents, most_forms=most_forms).collect()
    assert sorted((tuple(r) for r in found), key=repr) == plain_removal(made_documents(), 100)


def test_suffixes_in_small_loads(documents, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 64)  # every text in pieces
    monkeypatch.setattr(suffixes, "LOAD_BYTES", 500)
    monkeypatch.setattr(suffixes, "PART", 7)
    found = suffixes.remove_repeated(documents, window=50, gram=11).collect()
    assert sorted((tuple(r) for r in found), key=repr) == plain_removal(made_documents(), 50)
    assert suffixes.remove_repeated(documents.limit(0)).count() == 0


def test_suffix_order_and_cover():
    differences = {(a - b) % suffixes.PERIOD for a in suffixes.COVER for b in suffixes.COVER}
    assert differences == set(range(suffixes.PERIOD))
    random_ = np.random.default_rng(1)
    for letters, n in ((1, 400), (2, 2000), (4, 3000)):
        data = random_.integers(97, 97 + letters, n).astype(np.uint8)
        data = np.concatenate([data, data[: n // 2], data[100:300], np.full(300, 97, np.uint8)])
        text, places = data.tobytes(), np.arange(len(data) - 100)
        sorter = suffixes.SuffixSorter(data, 100)
        at, group = sorter.sort(places.copy())
        found = [text[i : i + 100] for i in at]
        assert found == sorted(found)
        assert all((found[i] == found[i + 1]) == (group[i] == group[i + 1]) for i in range(len(found) - 1))
        assert sorted(x for part in sorter.parts(places, 100) for x in part.tolist()) == places.tolist()


# --- tokens: pieces encoded in lines ---

PIECES = [
    "", " ", "\n", "a", " a", "a ", "a  b", "a\nb", "a \nb", "a\n b", "a\n\nb", "\na", "a\tb c", "a \tb", "don't 's 'll", "x.\u2028y z",
    "<|endoftext|>", "a<|endoftext|>b c", "a <|endoftext|> b", "naïve Größe 中文 字\u3000x", "a\u00a0b c\u00a0 d", "\x1c a\x1cb", "1 23 456.",
    "e\u0301 \u0301 x", "🙂🙂 🙂", "\x00 \x00a", "word, word. word", "\r\na b\r\nc", "a\u200b b \u200bc", "\x85a b\x85 c", "'s\n's",
]


@pytest.mark.parametrize("exact", [True, False])
def test_pieces_in_lines_have_the_ids_of_whole_texts(exact, monkeypatch):
    coder = tokens.Encoder(queries.tokenizer_path())
    if not exact:  # sizes that say nothing: pieces are then encoded one by one
        monkeypatch.setitem(coder.__dict__, "_token_bytes", np.ones(1 << 17, dtype=np.int64))
    draw = np.random.default_rng(5)
    texts = PIECES + ["".join(draw.choice([*PIECES, " ", "\n", "the"], 40)) for _ in range(300)]
    made = coder.encode(pa.array(texts))
    plain = coder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, np.uint32).tolist() for x in made] == [x.ids for x in plain]
    assert coder.encode(pa.array([], pa.string())) == []


def test_a_piece_is_encoded_once_a_call_and_without_control_strings(monkeypatch):
    coder, seen = tokens.Encoder(queries.tokenizer_path()), []

    class Watched:
        def encode_batch_fast(self, texts, **options):
            seen.extend(texts)
            return real.encode_batch_fast(texts, **options)

        def __getattr__(self, name):
            return getattr(real, name)

    real, coder.tokenizer = coder.tokenizer, Watched()
    words = [f"w{i}" for i in range(1000)]
    coder.encode(pa.array([" ".join(words)] * 3))
    assert sum(map(len, seen)) < 2 * sum(len(x) + 1 for x in words)
    assert not any(coder.mark in x for x in seen if "w7 " in x)


def test_parts_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "BYTES_AT_ONCE", 100)
    texts = pa.array(["x" * n for n in (0, 99, 30, 250, 0, 1)])
    parts = list(tokens._parts(texts))
    assert [i for a, b in parts for i in range(a, b)] == list(range(6)) and len(parts) > 2
    assert list(tokens._parts(pa.array([], pa.string()))) == []
