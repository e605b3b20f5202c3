"""Byte-level BPE, hard negatives and tokenizer alignment against the libraries and plain Python."""

import hashlib
import json
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm import byte_bpe, hard_negatives, queries, token_alignment

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PAIR = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def strange_texts():
    rng = random.Random(11)
    kinds = ["a", "Z", "é", "ж", "漢", "\U0001f600", "࢏", "\U00011de2", " ", "  ", "\n", "\t", "　", "\x1c", "7", "٣", "'ll", "'", "<|endoftext|>", "​", "\0"]
    return ["".join(rng.choices(kinds, k=rng.randint(1, 60))) for _ in range(300)]


def test_units_are_those_of_the_library(library):
    encoder = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for text in [*strange_texts(), "x" * 5000, "ab" * 3000 + " " * 700 + "\n" * 300, "", " "]:
        assert np.frombuffer(encoder.ids([text])[0], "<i4").tolist() == library.encode_ordinary(text), text[:80]


def test_every_character_is_classed_as_in_the_library(library):
    units = byte_bpe.Units(public_tokenizers.PATTERN)
    encoder = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for start in [*range(0, 0x34000, 0x1000), 0xE0000, 0xF0000, 0x10F000]:  # what lies between isn't assigned
        text = "".join(f"a{chr(c)}1" for c in range(start, start + 0x1000) if not 0xD800 <= c < 0xE000)
        if text:
            assert np.frombuffer(encoder.ids([text])[0], "<i4").tolist() == library.encode_ordinary(text), hex(start)
            assert "".join(u for part in units.of(text) for u in part) == text


def test_ties_go_to_the_leftmost_pair():
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 256, b"aaa": 257, b"ba": 258}
    assert byte_bpe.merged(b"aaaaa", ranks) == [256, 257]
    assert byte_bpe.merged(b"aaaabaa", ranks) == [256, 256, 98, 256]


def test_units_merged_together_are_merged_alike():
    ranks = byte_bpe.read_ranks(RANKS)
    pairs = byte_bpe.Pairs(ranks)
    single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
    rng = random.Random(9)
    alphabets = [b"ab", b"etaoin shrdlu", bytes(range(256)), "äöüß漢字".encode()]
    for width in (1, 2, 4, 8, 16, 32, 64):
        units = [bytes(rng.choices(rng.choice(alphabets), k=rng.randint(width // 2 + 1, width))) for _ in range(200)]
        ids, counts = byte_bpe.merged_together(units, width, pairs, single)
        for unit, found in zip(units, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
            assert found.tolist() == byte_bpe.merged(unit, ranks)


def test_long_texts_are_cut_between_units(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "STRETCH", 7)
    encoder = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for text in [" ".join(strange_texts()[:40]), "one  two \n three   ", "é" * 50 + " x"]:
        assert np.frombuffer(encoder.ids([text])[0], "<i4").tolist() == library.encode_ordinary(text)


def test_memory_of_units_is_bounded_and_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KNOWN_BYTES", 1000)
    monkeypatch.setattr(byte_bpe, "KNOWN_UNIT", 5)
    encoder = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for text in ["some longer words are not kept, shorter ones are"] * 3 + strange_texts()[:30]:
        assert np.frombuffer(encoder.ids([text])[0], "<i4").tolist() == library.encode_ordinary(text)


def test_odd_rows_round_trip(odd, none, library):
    found = byte_bpe.encoded(odd, RANKS, public_tokenizers.PATTERN).withColumn("text_", byte_bpe.decoded(F.col("ids"), RANKS).cast("string"))
    given = sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=str)
    rows = found.collect()
    assert sorted(((r.doc_id, r.text_) for r in rows), key=str) == given
    assert all(r.ids == library.encode_ordinary(r.text_) for r in rows)
    assert byte_bpe.encoded(none, RANKS, public_tokenizers.PATTERN).collect() == []


def test_bpe_query_digests(shared, library):
    found = {r.doc_id: r for r in queries.QUERIES["op11_segment_tree_bpe"](shared, FOLDER).collect()}
    for doc_id, text in shared.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(text or "")
        row = found.pop(doc_id)
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert not found


def test_ids_outside_the_file_stop(shared):
    with pytest.raises(Exception, match="isn't in the rank file"):
        shared.createDataFrame([([60000],)], "ids array<int>").select(byte_bpe.decoded(F.col("ids"), RANKS)).collect()


# hard negatives

def test_products_are_exact_at_any_size():
    rng = np.random.default_rng(3)
    for largest, width in ((150, 64), (30_000, 200), (2**23, 96)):
        a, b = (rng.integers(-largest, largest, (n, width), endpoint=True) for n in (17, 23))
        bound = int(max((m.astype(object) ** 2).sum(axis=1).max() for m in (a, b)))
        residues = hard_negatives.Residues(bound)
        assert (residues.multiply(residues.split(a), residues.split(b)) == a @ b.T).all()
    with pytest.raises(ValueError, match="don't fit"):
        hard_negatives.Residues(1 << 60)


def mined(rows, positives=5, negatives=3):
    """Plain Python over (row_no, vec_id, label, vector)."""
    usable = [(no, i, label, [math.floor(256.0 * x) for x in v]) for no, (i, v, label) in enumerate(rows)
              if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    last = lambda i: (i is None, i or 0)
    out = []
    for no, i, label, v in usable:
        if i is None or i % 50:
            continue
        scored = sorted(((sum(x * y for x, y in zip(v, w)), other, lab, n) for n, other, lab, w in usable if n != no),
                        key=lambda s: (-s[0], last(s[1]), s[3]))
        for score, other, _, _ in [s for s in scored if s[2] == label][:positives]:
            hits = [s for s in scored if s[2] != label and 50 * score <= 100 * s[0] <= 95 * score][:negatives]
            out += [(i, other, rank, s[1], score, s[0]) for rank, s in enumerate(hits, 1)]
    return sorted(out, key=str)


ODD_VECTORS = [
    (0, [0.5, 0.25, -0.5], 1), (0, [0.5, 0.25, -0.5], 1), (1, [0.5, 0.2, -0.4], 1), (2, [0.5, 0.2, -0.4], 1), (3, [0.3, 0.1, -0.3], 2),
    (4, [0.3, 0.1, -0.3], 2), (5, [0.3, 0.1], 2), (6, None, 1), (8, [0.1, None, 0.3], 1), (9, [0.1, float("nan"), 0.3], 1),
    (10, [0.1, float("inf"), 0.3], 1), (11, [0.4, 0.2, -0.4], None), (None, [0.4, 0.15, -0.4], 2), (None, [0.45, 0.2, -0.45], 1),
    (50, [], 1), (100, [0.0, 0.0, 0.0], 3), (150, [-0.2, -0.2, 0.4], 3), (151, [0.2, 0.2, -0.4], 3), (200, [0.4, 0.2, -0.3], 2),
]


def vectors(shared, rows):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                           T.StructField("label", T.IntegerType()), T.StructField("row_no", T.StringType()), T.StructField("whole", T.StringType())])
    return shared.createDataFrame([(*r, "x", "y") for r in rows], schema)


def run_mining(shared, rows):
    frame = hard_negatives.components(vectors(shared, rows), "vec_id", "embedding", "label")
    return sorted((tuple(r) for r in hard_negatives.hard_negatives(frame, F.col("vec_id") % 50 == 0).collect()), key=str)


def single(rows):
    return [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


def test_odd_vectors(shared):
    assert run_mining(shared, ODD_VECTORS) == mined(single(ODD_VECTORS))
    assert run_mining(shared, []) == []


def test_many_blocks_and_repeated_vectors(shared, monkeypatch):
    for name, size in (("ANCHOR_BLOCK", 3), ("ROW_BLOCK", 40), ("TILE", 17), ("SCORES", 300), ("LEAST", 30)):
        monkeypatch.setattr(hard_negatives, name, size)
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(6)], rng.randrange(3)) for i in range(170)]
    rows += [(1000 + i, rows[7][1], 1) for i in range(80)]  # a third under one vector
    assert run_mining(shared, rows) == mined(single(rows))


def test_component_too_large_stops(shared):
    with pytest.raises(ValueError, match="32 bits"):
        run_mining(shared, [(0, [1e9], 1)])


# alignment

def plain_alignment(texts):
    """(a, b, groups) of each text by whole-text encoding and a walk over both ends."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_lib = Tokenizer.from_file(PAIR[0])
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=PAIR[1])
    vocabulary = {i: s for s, i in json.load(open(PAIR[0]))["model"]["vocab"].items()}
    out = []
    for text in texts:
        if not text:
            out.append([])
            continue
        a = a_lib.encode(" " + text, add_special_tokens=False).ids
        b = b_lib.encode(text)
        spelled = (" " + text).encode()
        a_bytes = [token_alignment.byte_level(vocabulary[i]) for i in a]
        b_bytes = [token_alignment.piece_bytes(b_lib.id_to_piece(i)) for i in b]
        if b"".join(a_bytes) != spelled or b"".join(b_bytes) != spelled:
            out.append([])
            continue
        groups, i, j, left, right, a_own, b_own = [], 0, 0, 0, 0, [], []
        while i < len(a) or j < len(b):
            if left <= right and i < len(a):
                a_own.append(a[i])
                left += len(a_bytes[i])
                i += 1
            else:
                b_own.append(b[j])
                right += len(b_bytes[j])
                j += 1
            if left == right:
                groups.append((tuple(a_own), tuple(b_own)))
                a_own, b_own = [], []
        out.append(groups)
    return out


def expected_scores(keys, texts):
    aligned = plain_alignment(texts)
    count = Counter((a[-1], b[-1]) for groups in aligned for a, b in groups)
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    out = []
    for key, groups in zip(keys, aligned, strict=True):
        links = [(a[-1], b[-1]) for a, b in groups]
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((key, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                    sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(said.encode()).hexdigest() if said else ""))
    return sorted(out, key=str)


ODD_TEXTS = [None, "", " ", "  two", "ends ", "<s> <|endoftext|> <0x41> </s>", "under▁line", "naïve café 漢字 \U0001f600", "\n\tx", "a\0b", "　wide", "same words same words"]


def aligned_rows(frame, packed=False):
    alignment = token_alignment.stored(token_alignment.aligned(frame, *PAIR, packed=packed))
    return sorted((tuple(r) for r in token_alignment.alignment_scores(alignment).collect()), key=str)


def test_alignment_of_odd_rows(shared, odd, none):
    texts = [*ODD_TEXTS, *strange_texts()[:80]]
    frame = shared.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, a_ids int")
    assert aligned_rows(frame) == aligned_rows(frame, packed=True) == expected_scores(range(len(texts)), texts)
    rows = odd.collect()
    assert aligned_rows(odd) == expected_scores([r.doc_id for r in rows], [r.text for r in rows])
    assert aligned_rows(none) == aligned_rows(none, packed=True) == []


def test_alignment_query(shared):
    rows = shared.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = sorted((tuple(r) for r in queries.QUERIES["op13_pointer_alignment"](shared, FOLDER).collect()), key=str)
    assert found == expected_scores([r.doc_id for r in rows], [r.text for r in rows])


def test_doubling_reaches_the_end_of_long_chains():
    # bricks: A ends at 2, 4, 6 ..., B at 1, 3, 5 ..., and both at the very end
    a_end, b_end = np.arange(2, 2002, 2), np.append(np.arange(1, 2000, 2), 2000)
    a_group, b_group = token_alignment.labelled(a_end, b_end)
    assert not a_group.any() and not b_group.any()
    a_group, b_group = token_alignment.labelled(np.array([1, 3, 4]), np.array([1, 2, 3, 4]))
    assert a_group.tolist() == [0, 1, 2] and b_group.tolist() == [0, 1, 1, 2]


def test_stretches_change_nothing(shared, monkeypatch):
    pair = token_alignment.Pair(*PAIR)
    texts = [" ".join(t for t in strange_texts()[:50]), "one two  three four " * 20, None, "plain words only here"]
    whole = [[(v[0].tolist(), v[1].tolist()) for v in pair.align([t])] for t in texts]
    together = pair.align(texts)
    monkeypatch.setattr(token_alignment, "STRETCH", 9)
    monkeypatch.setattr(token_alignment, "KNOWN_BYTES", 100)
    monkeypatch.setattr(token_alignment, "CALL", 12)
    again = token_alignment.Pair(*PAIR)
    assert [[(v[0].tolist(), v[1].tolist()) for v in again.align([t])] for t in texts] == whole
    for i, (values, counts) in enumerate(together):
        assert values.tolist() == [x for one in whole for x in one[i][0]] and counts.tolist() == [one[i][1][0] for one in whole]
