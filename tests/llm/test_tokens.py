"""Encoding, decoding and packing beside the tokenizers library and a literal packer."""

import bisect
import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from statloom.llm import bpe, packing

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
PIECES = [*"abcdeAEIO01239'!?.,<|>\x00\x1c\x85\xa0\t\n   ", " ", "　", "é", "é", "́", "Σ", "ς", "İ", "ß", "日本", "🙂", "ﬁ", "²", "Ⅷ", "ǅ", "한", "'s", "'LL"]
PIECES += ["<|endoftext|>", "<|startoftext|>"]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 40))) for _ in range(n)] + ["a" * 3001, "ab" * 2000, "", " ", "aaa", "aaaa aaaaa"]


def test_encodes_as_the_library():
    texts = odd_texts(4000, 1)
    got = [x.tolist() for x in bpe.encode_batch(bpe.Vocabulary(PATH), texts)]
    want = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert [i for i, (a, b) in enumerate(zip(got, want)) if a != b] == []


def test_every_code_point_as_the_library():
    """Each between letters, between digits and alone, a thousand to a text."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}b {c} 1{c}" for c in points[i : i + 1000]) for i in range(0, len(points), 1000)]
    got = [x.tolist() for x in bpe.encode_batch(bpe.Vocabulary(PATH), texts)]
    want = [x.ids for x in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert [i for i, (a, b) in enumerate(zip(got, want)) if a != b] == []


def test_ranks_apply_in_ascending_order():
    """Each word beside the plain rule: merge the lowest pair again and again, from the left."""
    v = bpe.Vocabulary(PATH)
    rank = {(int(a), int(b)): i for i, (a, b) in enumerate(zip(v.left, v.right))}
    rng = random.Random(2)
    words = ["".join(rng.choices("abinothe", k=rng.randint(1, 30))) for _ in range(300)]
    index = bpe.PairIndex(v, words)
    index.merge_all()
    lists = index.tokens()
    for i, w in enumerate(words):
        raw = w.encode()
        symbols = [int(v.inner[b]) for b in raw[:-1]] + [int(v.last[raw[-1]])]
        while True:
            best = min((rank.get(p, 1 << 30), k) for k, p in enumerate(zip(symbols, symbols[1:]))) if len(symbols) > 1 else (1 << 30, 0)
            if best[0] == 1 << 30:
                break
            symbols[best[1] : best[1] + 2] = [int(v.made[best[0]])]
        assert lists.flat[lists.bounds[i] : lists.bounds[i + 1]].tolist() == symbols


def test_encode_and_decode_columns(make_docs, odd_docs):
    texts = odd_texts(200, 3)
    docs = make_docs(list(enumerate(texts))).selectExpr("*", "'clash' AS ids", "'clash' AS decoded")
    want = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    encoded = bpe.encode(docs, PATH, decoded="decoded")
    rows = sorted(encoded.collect(), key=lambda r: r.doc_id)
    assert [list(r.ids) for r in rows] == want
    assert [r.decoded for r in rows] == [LIBRARY.decode(i, skip_special_tokens=False) for i in want]
    back = sorted(bpe.decode(encoded, PATH).collect(), key=lambda r: r.doc_id)
    assert [r.text for r in back] == [r.decoded for r in rows]
    odd = bpe.encode(odd_docs, PATH).collect()
    assert len(odd) == odd_docs.count() and [list(r.ids) for r in odd if r.doc_id == 0] == [[]]
    assert bpe.encode(make_docs([]), PATH).count() == 0


def test_unknown_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([([320, -1, 10**7],), (None,), ([],)], "ids array<int>")
    assert [r.text for r in bpe.decode(rows, PATH).collect()] == [LIBRARY.decode([320]), "", ""]


def literal_bins(lengths, capacity):
    """Piece by piece: match the large, then the tightest gap for the small, longest first."""
    large = sorted(x for x in lengths if 3 * x > capacity)
    gaps = []
    while large:
        a = large.pop()
        at = bisect.bisect_right(large, capacity - a) - 1
        gaps.append(capacity - a - (large.pop(at) if at >= 0 else 0))
    gaps.sort()
    for x in sorted((x for x in lengths if 3 * x <= capacity), reverse=True):
        at = bisect.bisect_left(gaps, x)
        bisect.insort(gaps, (gaps.pop(at) if at < len(gaps) else capacity) - x)
    return len(gaps)


def check_places(places, capacity):
    """No overlap, no gap, nothing over the end."""
    by = collections.defaultdict(list)
    for sequence, offset, length in places:
        by[sequence].append((offset, length))
    for own in by.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_the_literal_packing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 30, 100, 4096])
    lengths = [min(capacity, max(1, int(rng.lognormvariate(np.log(capacity / rng.choice([2, 5, 20])), 1)))) for _ in range(rng.randint(1, 1500))]
    counts = collections.Counter(lengths)
    made = packing.plan(counts, capacity)
    place = packing._place(np.array(made.entries, np.int64))
    ranks = collections.Counter()
    import pandas as pd

    own = []
    for x in lengths:
        own.append(ranks[x])
        ranks[x] += 1
    got = place(pd.Series(lengths), pd.Series(own))
    bins = check_places(zip(got["sequence_id"], got["offset"], lengths), capacity)
    assert bins == made.sequences == literal_bins(lengths, capacity)


def test_packing_of_documents(make_docs, odd_docs, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_TASK", 7)  # hot lengths are split
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["the", "idea", "of", "things,"], k=rng.choice([0, 3, 3, 20, 300]))) for _ in range(150)]
    docs = make_docs(list(enumerate(texts)))
    pieces = packing.tokenise(docs, PATH, capacity=128)
    rows = packing.pack(pieces, capacity=128).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    for i, t in enumerate(texts):
        ids = [*LIBRARY.encode(t, add_special_tokens=False).ids, 1]
        own = sorted(by[i], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in own] == [(k, s, len(ids[s : s + 128])) for k, s in enumerate(range(0, len(ids), 128))]
        assert b"".join(bytes(r.ids) for r in own) == np.array(ids, "<u4").tobytes()
    check_places([(r.sequence_id, r.offset, r.length) for r in rows], 128)
    joined = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packing.pack(pieces, capacity=128)).collect()}
    assert all(len(x) <= 512 for x in joined.values()) and sum(map(len, joined.values())) == 4 * sum(r.length for r in rows)
    some = rows[0]
    assert zlib.crc32(bytes(some.ids)) == zlib.crc32(joined[some.sequence_id][4 * some.offset : 4 * (some.offset + some.length)])
    odd = packing.pack(packing.tokenise(odd_docs, PATH)).collect()
    check_places([(r.sequence_id, r.offset, r.length) for r in odd], 4096)
    assert sum(r.piece == 0 for r in odd) == odd_docs.count()
    assert packing.pack(packing.tokenise(make_docs([]), PATH)).count() == 0


def test_lengths_out_of_bounds(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 0, 5000)], "doc_id long, piece int, length long"))
