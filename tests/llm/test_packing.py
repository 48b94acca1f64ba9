import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from eventmart.llm import packing

PATH = packing.vocabulary_path()
TEXTS = [
    "", " ", "plain words", "ünï cödé 😀 ", "a<|endoftext|>b", "x" * 5000, "tabs\t\nand   spaces", "It's 12,345.67 they're",
    "中文字符 العربية", "the quick brown fox " * 900,
]


def test_both_libraries_give_the_same_ids():
    slow, _ = packing._encoders(PATH)
    rng = random.Random(1)
    some = TEXTS + ["".join(rng.choices("ab é\n\t '.1😀<|>", k=50)) for _ in range(300)]
    for text in some:
        want = [*slow.encode(text, add_special_tokens=False).ids, packing.END]
        assert packing.token_ids(text, PATH).tolist() == want


def checked(out, texts, length):
    """Pieces cover each document once, sequences hold together; returns their sizes."""
    slow, _ = packing._encoders(PATH)
    pieces = defaultdict(list)
    for r in out:
        pieces[r["doc_id"]].append(r)
    assert pieces.keys() == texts.keys()
    for doc, rows in pieces.items():
        ids = [*slow.encode(texts[doc] or "", add_special_tokens=False).ids, packing.END]
        at = 0
        for r in sorted(rows, key=lambda r: r["start"]):
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
            at += r["length"]
        assert at == len(ids)
    sequences = defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    sizes = []
    for places in sequences.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        sizes.append(at)
    assert max(sizes, default=0) <= length
    return sizes


def test_pieces_and_places(docs):
    rng = random.Random(2)
    texts = {i: " ".join(f"w{rng.randrange(999)}" for _ in range(rng.randrange(900))) for i in range(300)}
    texts |= {1000 + i: t for i, t in enumerate(TEXTS)} | {2000: None}
    table = docs(list(texts.items()))
    sizes = checked(packing.pack(table, with_ids=False).collect(), texts, 1024)
    # what remains open is little: at most a few hundredths of all
    assert len(sizes) * 1024 <= 1.03 * sum(sizes) + 1024


def test_sequences_hold_the_ids(docs):
    texts = dict(enumerate(TEXTS))
    packed = packing.pack(docs(list(texts.items())), length=64)
    checked(packed.collect(), texts, 64)
    rows = sorted(packed.collect(), key=lambda r: (r["sequence_id"], r["offset"]))
    want = defaultdict(list)
    for r in rows:
        want[r["sequence_id"]] += r["ids"]
    got = {r["sequence_id"]: r["tokens"] for r in packing.sequences(packed).collect()}
    assert got == dict(want)


@pytest.mark.parametrize("seed", range(8))
def test_patterns_use_each_length_exactly(seed):
    rng = random.Random(seed)
    histogram = {rng.randrange(1, 101): rng.randrange(1, 5000) for _ in range(60)}
    patterns = packing.shortest_pack_first(histogram, 100)
    used = defaultdict(int)
    for sizes, count in patterns:
        assert count > 0 and sum(sizes) <= 100 and list(sizes) == sorted(sizes, reverse=True)
        for size in sizes:
            used[size] += count
    assert used == histogram
    # no more sequences than the same rule gives one piece at a time
    room = []
    for size in sorted(histogram, reverse=True):
        for _ in range(histogram[size] // 50):
            best = max(range(len(room)), key=room.__getitem__, default=None)
            if best is None or room[best] < size:
                room.append(100 - size)
            else:
                room[best] -= size
    small = packing.shortest_pack_first({k: v // 50 for k, v in histogram.items() if v >= 50}, 100)
    assert sum(c for _, c in small) == len(room)


def test_slots_cover_all_ranks():
    patterns = packing.shortest_pack_first({9: 5, 4: 11, 1: 3}, 10)
    ranks = defaultdict(list)
    for size, first, count, _, _ in packing.slots(patterns):
        ranks[size] += range(first, first + count)
    assert {k: sorted(v) for k, v in ranks.items()} == {9: [*range(5)], 4: [*range(11)], 1: [*range(3)]}


def test_odd_rows(odd, no_docs):
    out = packing.pack(odd, with_ids=False).collect()
    assert sum(r["doc_id"] == 4 for r in out) == 2 * len({r["start"] for r in out if r["doc_id"] == 4})
    for doc in (1, 2):
        assert [r["doc_tokens"] for r in out if r["doc_id"] == doc] == [1]
    total = defaultdict(int)
    for r in out:
        assert r["offset"] + r["length"] <= 1024
        total[r["sequence_id"]] += r["length"]
    assert max(total.values()) <= 1024
    assert packing.pack(no_docs).collect() == []


@pytest.mark.parametrize("blank", [" ", "\n", "\t", "\r\n", " "])
def test_long_runs_of_blanks(spark, docs, blank):
    """Runs for which the faster library has no stack; ids are those of the other."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.vocabulary_path())
    texts = {1: blank * 2_000_000, 2: "word " + blank * 12_000 + "end", 3: blank * 9_000}
    out = packing.pack(docs(list(texts.items()))).collect()
    for i, text in texts.items():
        ids = [n for r in sorted(out, key=lambda r: r["start"]) if r["doc_id"] == i for n in r["ids"]]
        assert ids == [*plain.encode(text, add_special_tokens=False).ids, packing.END]


def test_ids_stay_with_their_pieces(spark, docs):
    """Repeated rows and rows of one id: each piece has the ids that its checksum is of."""
    import zlib

    import numpy as np

    rows = [(i % 7, f"text {i % 20} " * (i * 13 % 700)) for i in range(150)]
    for r in packing.pack(docs(rows), 256).collect():
        assert r["length"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
