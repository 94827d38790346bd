"""Substring dedup, byte-level BPE, line dedup, token counts and LM scores against brute force."""

import hashlib
import math
import struct
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from ledgerlift.llm import bpe as bpe_module, lm_scoring as lm
from ledgerlift.llm.bpe import bpe
from ledgerlift.llm.common import crc_mod, table
from ledgerlift.llm.line_dedup import PAIR, build_index, line_dedup, line_key, probe_index
from ledgerlift.llm.lm_scoring import lm_scores
from ledgerlift.llm.queries import ORACLES, QUERIES, vocabulary
from ledgerlift.llm.substring_dedup import substring_dedup
from ledgerlift.llm.token_counts import token_counts

FOLDER = Path("/root/testdata/sf0.001")
mounted = pytest.mark.skipif(not FOLDER.exists(), reason="test tables not mounted")
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
SAME = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
TEXTS = [
    (1, SAME), (2, f"zero {SAME} tail\nLine  A \n\tline a\nx"), (3, None), (4, ""), (5, " \t\n\r\x0b\x0c "),
    (6, LONG), (7, f"{SAME}\n{LONG[:3000]}"), (8, "Ünïcode ≥ 日本語 😀 don't  x"), (8, SAME), (None, SAME), (None, None),
    (9, "line a"), (10, "LINE A\r\nother"), (2, f"zero {SAME} tail\nLine  A \n\tline a\nx"),
]
DDL = "doc_id bigint, text string, block string, keys int, learn string, pieces double, count string, shard int"


def frame(spark, rows):
    """Extra columns whose names the operators use inside, partly null."""
    return spark.createDataFrame([(i, t, None, 1, "x", None, "c", 3) for i, t in rows], DDL)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def compared(spark, name):
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = connection.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    df = QUERIES[name](spark, str(FOLDER))
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(result.fetchall())


@mounted
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    compared(spark, name)


def brute_substrings(rows, window):
    words = [(i, [w for w in (t or "").encode().split()]) for i, t in rows]
    first = defaultdict(lambda: math.inf)
    rank = lambda i: math.inf if i is None else i
    for i, w in words:
        for a in range(len(w) - window + 1):
            k = tuple(w[a : a + window])
            first[k] = min(first[k], rank(i))
    out = []
    for i, w in words:
        gone = set()
        for a in range(len(w) - window + 1):
            if first[tuple(w[a : a + window])] < rank(i):
                gone.update(range(a, a + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), sha(kept)))
    return out


@pytest.mark.parametrize("window", [13, 1, 4])
def test_substring_dedup_edges(spark, rows, window):
    got = rows(substring_dedup(frame(spark, TEXTS), window=window, digest=True))
    key = lambda t: tuple((v is None, str(v)) for v in t)
    assert got == sorted(brute_substrings(TEXTS, window), key=key)


def test_substring_dedup_returns_texts_and_spans(spark):
    got = {r.doc_id: r for r in substring_dedup(frame(spark, TEXTS[:2]), window=13).collect()}
    assert got[1].kept_text == SAME and got[1].removed == []
    assert got[2].removed == [[1, 15]] and got[2].kept_text.split()[:2] == ["zero", "tail"]
    assert substring_dedup(frame(spark, []), window=13).count() == 0


def test_minimal_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 2**63, (5000, 2)).astype("<u8").view(PAIR).reshape(-1)
    index = build_index(keys, np.arange(5000) + 1)
    assert (probe_index(index, keys) == np.arange(5000) + 1).all()
    others = np.random.default_rng(2).integers(0, 2**63, (5000, 2)).astype("<u8").view(PAIR).reshape(-1)
    assert (probe_index(index, others) > 0).sum() <= 1
    assert probe_index(build_index(keys[:0], np.zeros(0, int)), others).sum() == 0


@pytest.mark.parametrize("min_docs,min_chars", [(3, 1), (2, 6), (10, 1)])
def test_line_dedup_edges(spark, rows, min_docs, min_chars):
    lines = [(i, (t or "").encode().split(b"\n")) for i, t in TEXTS]
    held = Counter(k for _, ls in lines for k in {line_key(x) for x in ls} if len(k.decode()) >= min_chars)
    expected = []
    for i, ls in lines:
        kept = [x for x in ls if held[line_key(x)] < min_docs]
        expected.append((i, len(ls), len(ls) - len(kept), sha(b"\n".join(kept))))
    got = rows(line_dedup(frame(spark, TEXTS), min_docs, min_chars, digest=True))
    assert got == sorted(expected, key=lambda t: tuple((v is None, str(v)) for v in t))
    carried = line_dedup(frame(spark, TEXTS[:3]), min_docs, min_chars, carry=["keys", "block"])
    assert carried.columns == ["doc_id", "n_lines", "n_dropped", "kept_text", "keys", "block"] and carried.count() == 3
    assert line_dedup(frame(spark, []), min_docs).count() == 0


PIECES = ["a" * 3000 + " x", "ab" * 40 + " " * 70 + "z", "x\u0085y 　 z", "½²Ⅷ'll DON'T 'S 's", "日本語テキスト 😀😀퟿", "\n\n \t  tail "]


def test_bpe_matches_the_tokenizer_library(spark):
    path, pattern = vocabulary()
    ranks = bpe_module.load_ranks(path)
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rows = TEXTS + [(100 + i, t) for i, t in enumerate(PIECES)]
    expected = sorted(
        (str(i), len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha((t or "").encode()))
        for i, t in rows
        for ids in [encoding.encode_ordinary(t or "")]
    )
    got = bpe(frame(spark, rows), path, pattern, form="digest").collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == expected
    full = bpe(frame(spark, rows), path, pattern).collect()
    texts = sorted((t or "").encode() for _, t in rows)
    assert sorted(bytes(r.decoded) for r in full) == texts  # exact round trip
    assert all(r.n_tokens == len(r.ids) for r in full)
    assert bpe(frame(spark, []), path, pattern).count() == 0
    for word in (b"a" * 500, "größenwahnsinnig".encode() * 9, bytes(range(256))):
        assert bpe_module.heap_merges(word, ranks) == encoding._encode_single_piece(word)


def test_new_pieces_are_listed_in_bulk(monkeypatch):
    """One array per list of new pieces: no conversion per piece; long pieces go apart."""
    import numpy

    calls = []
    monkeypatch.setattr(bpe_module.np, "frombuffer", lambda *x, f=numpy.frombuffer: calls.append(x) or f(*x))
    pieces = [[f"w{i}" for i in range(50)] + ["x" * 70, "w1"], None, [], ["w1", "y" * 64, "z" * 65]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array(pieces, pa.list_(pa.string()))], ["doc_id", "pieces"])
    run = bpe_module._number_pieces(list(range(256)))
    (listed,) = run([batch])
    row = listed.to_pylist()[0]
    flat = [w for x in pieces for w in x or []]
    distinct = list(dict.fromkeys(flat))
    assert row["words"] == [None if len(w) > 64 else list(w.encode()) for w in distinct]
    assert row["long"] == [w.encode() for w in distinct if len(w) > 64] and row["counts"] == [52, 0, 0, 3]
    assert numpy.array(row["codes"] and memoryview(row["codes"]).cast("i")).tolist() == [distinct.index(w) for w in flat]
    assert len(calls) == 1
    (none,) = run([batch.slice(1, 2)])
    assert none.to_pylist()[0]["words"] == [] and none.to_pylist()[0]["counts"] == [0, 0]


def test_token_counts(spark):
    lengths = [0, 0, 3, 3, 3, 1023, 1024, 5000, 5000, None]
    got = {r.context_limit: r for r in token_counts(spark.createDataFrame([(x, "c") for x in lengths], "n_tokens long, docs string")).collect()}
    known = [x for x in lengths if x is not None]
    assert set(got) == set(known)
    for limit, r in got.items():
        assert (r.docs, r.tokens) == (known.count(limit), known.count(limit) * limit)
        assert r.docs_at_least == sum(x >= limit for x in known) and r.docs_over == sum(x > limit for x in known)
        assert r.tokens_at_least == sum(x for x in known if x >= limit)
        assert r.kept_tokens == sum(min(x, limit) for x in known) and r.kept_tokens + r.lost_tokens == sum(known)
        assert (r.total_docs, r.total_tokens) == (len(known), sum(known))
        assert r.quantile == pytest.approx(sum(x <= limit for x in known) / len(known))
    assert token_counts(spark.createDataFrame([], "n_tokens long")).count() == 0


def test_lm_scores(spark):
    rows = TEXTS + [(20 + i, f"{SAME} common words here {i}") for i in range(40)]
    docs = frame(spark, rows)
    got = lm_scores(docs, crc_mod(7) != 2).collect()
    learns = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 != 2
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    counts = Counter(w for i, ws in tokens if learns(i) for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    expected = sorted(
        (str(i), not learns(i), len(ws), sum(counts[w] > 0 for w in ws), round(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in ws), 6))
        for i, ws in tokens
    )
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == expected
    assert {r.train_tokens for r in got} == {total}
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    of = {r.doc_id: r for r in got}
    assert of[20].score / of[20].n_tokens > of[8].score / of[8].n_tokens  # what was learned is likelier
    assert lm_scores(frame(spark, []), crc_mod(7) != 2).count() == 0
    untaught = lm_scores(frame(spark, TEXTS[:4]), F.lit(None).cast("boolean")).collect()
    assert all(r.n_known == 0 and r.held_out and r.score < 0 for r in untaught)


@mounted
@pytest.mark.parametrize("steps", [1, 7, 64, 5000])
def test_lm_mixing_in_runs_of_steps(monkeypatch, steps):
    """Every bit costs what a plain loop over its segment says, however many steps are fetched at once."""
    monkeypatch.setattr(lm, "STEPS", steps)

    def texts(*x):
        return pa.array([t.encode() for t in x], pa.large_binary())

    train = pa.RecordBatch.from_arrays([texts("the cat sat on the mat " * 40, "a dog ran off " * 30)], ["text"])
    model = lm.Model([r for x in lm._count_bytes([train]) for r in x.to_pylist()])
    data, edges, tokens, *_ = lm.coded_bytes(texts("the cat sat on the mat " * 30, "ZZ \U0001f600 \u00e9 " * 15 + "the cat", "", "qq cat "))
    start, stop, lengths, sizes = model._cut(data, edges)
    needs = np.concatenate(list(model._needs(data, edges, start, stop, sizes)))
    want, at = [], 0
    for n in lengths:
        w, extra, bias = lm.FIRST_WEIGHTS.astype(float) * lm.STRETCH_STEP, np.zeros(3), 0.0
        for *s, flags in needs[at : at + n].astype(float):
            s, bit, gate = np.array(s), flags % 2, flags // 2
            dot = np.clip(bias + s @ (w + gate * extra), -12, 12)
            err = bit - 1 / (1 + np.exp(-dot))
            want.append(-np.log1p(np.exp(-dot if bit else dot)))
            bias += err * float(lm.BIAS_RATE)
            w, extra = w + s * err * float(lm.RATE), extra + gate * s * err * float(lm.RATE)
        at += -(-n // steps) * steps
        want += [0.0] * (at - len(want))
    assert len(set(lengths)) > 3 and max(lengths) > 2 * 64 and lengths.sum() == model.sizes[data].sum()
    assert np.allclose(model._mix(lengths, needs), want, rtol=0, atol=1e-4)
    bits = np.cumsum(sizes) - sizes
    assert np.allclose(model.token_logs(data, edges, tokens), np.add.reduceat(want, bits[tokens[:-1]]), rtol=0, atol=1e-3)


def test_token_counts_query(spark):
    path, pattern = vocabulary()
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe_module.load_ranks(path), special_tokens={})
    known = Counter(len(encoding.encode_ordinary(r.text or "")) for r in table(spark, str(FOLDER), "documents").collect())
    assert {r.context_limit: r.docs for r in QUERIES["op10_token_counts"](spark, str(FOLDER)).collect()} == known
