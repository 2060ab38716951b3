"""Tiling, language ID, token counts, mixing (op1, op8, op6, op4), and the pipeline."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from verbatide.llm import decontaminate as D
from verbatide.llm import langid_cnn as L
from verbatide.llm import mixing as M
from verbatide.llm import token_counts as T
from verbatide.llm.decontaminate import token_parts
from verbatide.llm.queries import MIX_WEIGHTS, label_domains
from verbatide.llm.windows import parts_of


def plain_tiles(doc, item, least):
    free_doc, free_item, covered = [True] * len(doc), [True] * len(item), 0
    while True:
        best = (0,)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while (
                    i + n < len(doc) and j + n < len(item) and free_doc[i + n] and free_item[j + n]
                    and doc[i + n] == item[j + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n = best[0]
        if n < least:
            return covered
        for k in range(n):
            free_doc[best[1] + k] = free_item[best[2] + k] = False
        covered += n


def test_tiles_match_plain_greedy():
    draw = random.Random(1)
    for _ in range(150):
        item = [draw.randint(1, 6) for _ in range(draw.randint(5, 40))]
        doc = [draw.randint(1, 6) for _ in range(draw.randint(5, 60))]
        got = D.tile([np.array(doc, np.uint64)], np.array(item, np.uint64), 3)
        assert got == plain_tiles(doc, item, 3)


def test_contaminated(spark, documents):
    item = [f"tok{i}" for i in range(30)]
    moved = " ".join(["noise"] * 50 + item[20:] + ["x"] * 9 + item[10:20] + ["y"] + item[:10])
    rows = [
        (1, moved.upper().replace(" ", ", ")),  # reordered, other case and punctuation
        (2, " ".join(item[:14])),  # under half
        (3, " ".join(item[:15])),  # half
        (4, None), (5, ""), (6, "tok1 tok2"), (7, " ".join(w + "z" for w in item)),
        (8, "word " * 60000 + " ".join(item)), (None, " ".join(item)), (3, "again"), (9, " ".join(item)),
    ]
    bench = spark.createDataFrame(
        [(10, " ".join(item)), (11, "too short"), (12, None), (None, " ".join(item)), (10, " ".join(item))],
        "item_id long, text string",
    )
    df = documents(rows)
    got = {(r.doc_id, r.item_id): r.tiled_words for r in D.contaminated(df, bench).collect()}
    assert got == {(1, 10): 30, (3, 10): 15, (8, 10): 30, (9, 10): 30}
    kept = D.drop_contaminated(df, bench)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 4, 5, 6, 7]
    assert kept.columns == df.columns
    assert D.contaminated(df, bench.limit(0)).collect() == []
    assert D.contaminated(documents([]), bench).collect() == []


def test_contaminated_finds_all_in_table(spark, small, small_texts):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    want = {(d, i) for d, t in small_texts for i, b in bench if b in t}
    got = D.contaminated(
        spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/benchmark.parquet")
    )
    assert {(r.doc_id, r.item_id) for r in got.collect()} >= want and want


def test_gradients_match_differences():
    draw = np.random.default_rng(0)
    net = L.Network(["a", "b", "c"])
    rows, target = draw.integers(0, 20, (6, 40)).astype(np.uint8), draw.integers(0, 3, 6)
    loss = lambda: -np.log(net.predict(rows, net.pairs())[np.arange(6), target]).mean()
    for p, g in zip(net.parameters(), net.gradients(rows, target)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        held = p[at]
        p[at] = held + 1e-2
        up = loss()
        p[at] = held - 1e-2
        down = loss()
        p[at] = held
        assert abs((up - down) / 2e-2 - g[at]) < 0.05 * abs(g[at]) + 1e-3


def test_language_id(spark, documents, small_docs):
    network = L.learn(small_docs)
    judged = L.predict_languages(small_docs, network).join(small_docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in judged if r.held_out]
    assert len(held) > 30 and np.mean([r.lang == r.lang_pred for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in judged)
    english = "The thion of and there is an other of the."
    rows = [(1, None), (2, ""), (3, "123 %%% \n"), (4, english), (4, english), (None, english), (5, english * 60000)]
    df = documents(rows)
    got = sorted((r.doc_id or 0, r.lang_pred, r.held_out) for r in L.predict_languages(df, network).collect())
    assert [g[1] for g in got] == ["en", "und", "und", "und", "en", "en", "en"]
    assert got[0][2] is False
    kept = L.accept_languages(df, network)
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4, 4, 5]
    # Nothing to learn from: no language at all.
    assert {r.lang_pred for r in L.identify(df).collect()} == {"und"}
    assert L.identify(documents([])).collect() == []


def test_held_out_is_not_learned(small_docs):
    from pyspark.sql import functions as F

    swapped = small_docs.withColumn(
        "lang", F.when(L.is_held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))
    )
    assert "xx" not in L.learn(swapped).languages


def test_token_counts(documents, small_docs, small_texts):
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    tokenizer = tokenizers.Tokenizer.from_file(path)
    count = lambda t: len(tokenizer.encode(t or "", add_special_tokens=False))
    odd = ["", None, "a<|endoftext|>b <|endoftext|>", "  x  \n\n y\x1c\x85z", "I'm you'LL 123abc", "x" * 50000,
           " " * 3000, "日本語 😀 é½²٣\u200b", "\u2028 a\u3000b", "tab\t\tend ", "a\r\n b"]
    rows = [*enumerate(odd), (2, odd[2]), (None, "no id")]
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens, r.over_limit)
                 for r in T.token_counts(documents(rows), path).collect())
    want = sorted((i if i is not None else -1, len((t or "").encode()), count(t), count(t) > 512) for i, t in rows)
    assert got == want
    got = {r.doc_id: r.n_tokens for r in T.token_counts(small_docs, path).collect()}
    assert got == {d: count(t) for d, t in small_texts}
    assert T.token_counts(documents([]), path).collect() == []


def test_tail_of_the_vocabulary_is_joined(monkeypatch, small_docs, small_texts):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    whole = {r.doc_id: r.n_tokens for r in T.token_counts(small_docs, path).collect()}
    monkeypatch.setattr(T, "HEAD_SIZE", 5)
    assert {r.doc_id: r.n_tokens for r in T.token_counts(small_docs, path).collect()} == whole


def test_rates_meet_targets(spark):
    draw = np.random.default_rng(3)
    posterior = draw.dirichlet([0.3, 0.3, 0.3], 300)
    tokens = draw.integers(0, 500, 300)
    df = spark.createDataFrame(
        [(i, int(n), p.tolist()) for i, (n, p) in enumerate(zip(tokens, posterior))],
        "doc_id long, n_tokens long, posterior array<double>",
    )
    wanted = np.array([0.7, 0.25, 0.05]) * tokens.sum()
    rates = np.array([r.rate for r in M.fit_rates(df, list(wanted)).orderBy("doc_id").collect()])
    assert (rates >= 0).all()
    assert np.allclose((rates * tokens) @ posterior, wanted, atol=1e-5 * tokens.sum())
    # A domain without documents stays short of its target; the others meet theirs.
    two = df.selectExpr("doc_id", "n_tokens", "array(0.25, 0.75, 0.0) posterior")
    rates = [r.rate for r in M.fit_rates(two, [100.0, 300.0, 50.0]).collect()]
    assert min(rates) >= 0 and abs(np.dot(rates, tokens) - 400) < 1e-3
    assert M.fit_rates(df.limit(0), [1.0, 1.0, 1.0]).collect() == []
    assert {r.rate for r in M.fit_rates(df.filter("n_tokens = 0"), [1.0, 1.0, 1.0]).collect()} <= {0.0}


def test_mix(spark, small, small_docs, documents):
    labels = label_domains(spark.read.parquet(f"{small}/labels.parquet"))
    rows = M.mix(small_docs, labels, MIX_WEIGHTS).collect()
    assert len(rows) == small_docs.count()
    tokens = np.array([r.n_tokens for r in rows])
    totals = sum(r.rate * r.n_tokens * np.array(r.posterior) for r in rows) / tokens.sum()
    assert np.allclose(totals, [MIX_WEIGHTS[d] for d in sorted(MIX_WEIGHTS)], atol=0.01)
    assert all(abs(r.copies - r.rate) < 1 for r in rows)
    odd = documents([(1, None), (2, ""), (None, "some words"), (3, "a b c"), (3, "a b c")])
    assert M.mix(odd, labels, MIX_WEIGHTS).count() == 5
    assert M.mix(odd, labels.limit(0), MIX_WEIGHTS).count() == 5
    assert M.mix(documents([]), labels, MIX_WEIGHTS).collect() == []


def test_pipeline(spark, small, small_docs, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = small_docs
    for name, stage in pipeline.STAGES:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        assert {r.doc_id for r in after.select("doc_id").collect()} <= before
        if name != "mixing":
            assert after.columns == small_docs.columns
            docs = after
    assert after.count() == docs.count() > 0.8 * small_docs.count()
    texts = [r.text for r in docs.select("text").collect()]
    assert len(texts) == len(set(texts))


def test_repeated_rows_train_once(spark, documents, monkeypatch):
    """Copies of a row neither reach the driver nor take other rows' places in the draw."""
    rows = [(i, f"text number {i} of some words {'abc'[i % 3]}", "en") for i in range(1, 40)]
    more = [*rows, *rows[:1] * 500, *rows[1:2] * 500]
    seen = []
    monkeypatch.setattr(L, "train", lambda rows, target, languages: seen.append(sorted(map(bytes, rows))))
    monkeypatch.setattr(M.Classifier, "fit", lambda self, rows, target: seen.append(len(rows)) or self)
    labels = spark.createDataFrame([(i, "good") for i, *_ in rows], "doc_id long, domain string")
    for docs in (documents(rows), documents(more)):
        L.learn(docs)
        M.train_classifier(docs, labels, ["good", "low"])
    assert seen[0] == seen[2] and seen[1] == seen[3] == 39


def test_rates_go_on_until_targets_are_met(spark, caplog):
    """A fit that needs more than 60 rounds, and one that cannot be met, which says so."""
    draw = np.random.default_rng(0)
    posterior, tokens = draw.dirichlet([1] * 3, 40), draw.integers(1, 500, 40)
    df = spark.createDataFrame(
        [(i, int(n), p.tolist()) for i, (n, p) in enumerate(zip(tokens, posterior))],
        "doc_id long, n_tokens long, posterior array<double>",
    ).coalesce(1)
    wanted = np.array([0.6, 0.3, 0.1]) * tokens.sum()
    rates = np.array([r.rate for r in M.fit_rates(df, list(wanted)).orderBy("doc_id").collect()])
    assert np.abs((rates * tokens) @ posterior - wanted).max() <= 2e-6 * tokens.sum()
    assert not caplog.records
    two = df.selectExpr("n_tokens", "array(0.25, 0.75, 0.0) posterior")
    M.fit_rates(two, [100.0, 300.0, 50.0])
    assert "targets [100.0, 300.0, 50.0]" in caplog.text


def test_symbols_of_a_large_batch_take_bounded_memory():
    # The symbols of a whole batch's texts used to be held at once.
    texts = [None, "", "ein Wort"] + [f"w{i} " * 4000 for i in range(1000)] + ["long " * 300_000, "end"]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    tracemalloc.start()
    ids, counts = [], []
    for part, symbols, at in token_parts(batch):
        ids += part.column("doc_id").to_pylist()
        counts += np.diff(at).tolist()
        assert len(symbols) == at[-1] and (part.num_rows == 1 or part.column("text").nbytes < 2 << 20)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ids == list(range(len(texts)))
    assert counts == [0, 0, 2] + [4000] * 1000 + [300_000, 1]
    assert most < 100e6
    assert [p.num_rows for p in parts_of(batch.slice(1, 0))] == []
    assert [p.num_rows for p in parts_of(batch.slice(1002, 2))] == [1, 1]
