import zlib

import numpy as np
import pytest

from eventmart.llm import language as lang

FOLDER = "/root/testdata/sf0.01"


def test_slopes_equal_differences():
    """Backpropagation through time against small changes of single weights."""
    rng = np.random.default_rng(1)
    reader = lang.Reader(
        rng.normal(size=(3 * lang.HIDDEN, 256)), rng.normal(size=(3 * lang.HIDDEN, lang.HIDDEN))
    )
    windows = rng.integers(0, 256, (7, 5)).astype(np.uint8)
    mask = (rng.random((7, 5)) < 0.8).astype(float)
    aim = rng.normal(size=(7, lang.HIDDEN, 5))

    def loss():
        return float((reader.read(windows, mask)[0] * aim).sum())

    _, steps = reader.read(windows, mask, keep=True)
    for weights, slopes in zip(
        (reader.by_byte, reader.recurrent), reader.learn(windows, mask, steps, aim)
    ):
        for place in zip(*np.nonzero(np.abs(slopes) > np.quantile(np.abs(slopes), 0.97))):
            before, step = weights[place], 1e-2
            weights[place] = before + step
            up = loss()
            weights[place] = before - step
            down = loss()
            weights[place] = before
            assert (up - down) / (2 * step) == pytest.approx(slopes[place], rel=0.05, abs=0.02)


def test_windows_cover_all_bytes():
    texts = [b"", b"abc", b"x" * 64, b"y" * 200]
    windows, mask, owner = lang.cut(texts)
    for i, text in enumerate(texts):
        mine = owner == i
        assert bytes(windows[:, mine].T[mask[:, mine].T > 0]) == text


@pytest.fixture(scope="module")
def predicted(spark):
    from eventmart.llm.queries import QUERIES

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang", "text")
    return docs.join(QUERIES["op5_identify_language"](spark, FOLDER), "doc_id").collect()


def test_held_out_accuracy(predicted):
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in predicted)
    unseen = [r["lang"] == r["lang_pred"] for r in predicted if r["held_out"]]
    assert len(unseen) > 150 and np.mean(unseen) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in predicted)


def test_long_texts_are_pooled_in_parts(monkeypatch):
    rng = np.random.default_rng(2)
    net = lang.train([b"the house and the tree " * 9, b"das haus und der baum " * 9], ["en", "de"], 5)
    text = bytes(rng.integers(97, 123, 5000).astype(np.uint8))
    whole = net.pooled([text, b"", text[:77]])
    parts = list(lang._groups([text, b"", text[:77]], 640))
    assert len(parts) > 5 and b"".join(p for g, _ in parts for p in g) == text + text[:77]
    monkeypatch.setattr(lang, "_groups", lambda texts: iter(parts))
    assert np.allclose(net.pooled([text, b"", text[:77]]), whole, atol=1e-6)
    assert len(net.labels(text)) == len(text)


def test_odd_rows(odd, no_docs):
    texts = [b"the house and the tree of life " * 9, b"das haus und der baum des lebens " * 9]
    net = lang.train(texts, ["en", "de"], 20)
    out = lang.identify(odd.select("doc_id", "text"), net).collect()
    assert len(out) == odd.count()
    by_id = {r["doc_id"]: r for r in out}
    for i in (1, 2, 3):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert by_id[7]["lang_pred"] in ("en", "de")
    assert lang.fit(no_docs) is None
    nothing = lang.identify(odd.select("doc_id", "text"), None).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    assert lang.identify(no_docs.select("doc_id", "text"), net).collect() == []


def test_sample_leaves_out_what_is_held_out(docs):
    rows = [(i, f"text {i}", ["en", "de", None][i % 3], None) for i in range(400)]
    known = {f"text {i}" for i in range(400) if i % 3 != 2 and zlib.crc32(str(i).encode()) % 4 != 2}
    few = lang.sample(docs(rows), 20).collect()
    assert {r["text"] for r in few} <= known
    assert sorted(r["lang"] for r in few) == ["de"] * 20 + ["en"] * 20
    assert {r["text"] for r in lang.sample(docs(rows), 1000).collect()} == known
