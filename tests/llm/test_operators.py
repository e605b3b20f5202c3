"""Each operator against plain Python on the small tables and on odd rows."""

import json
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.llm import chat, decontaminate, exact_dedup, jaccard_join, language, line_dedup, packing, pitman_yor, queries, sharding, token_counts, words
from plumbline.llm import components as component_lists
from plumbline.llm.components import components
from tests.llm import brute
from tests.llm.conftest import FOLDER, ODD


def rows(frame):
    return [r.asDict() for r in frame.collect()]


def ordered(found):
    return sorted(json.dumps(r, default=str, sort_keys=True) for r in found)


# Shared helpers

@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \tAaBbé1.,\n ", max_size=40)), max_size=8), st.integers(1, 16))
def test_word_hashes_follow_words(texts, block):
    import pyarrow as pa

    whole, words.BLOCK = words.BLOCK, block
    try:
        for table, pattern in ((words.NOT_SPACE, brute.SPACED), (words.ALPHANUMERIC, brute.ALNUM)):
            hashes, counts = words.hash_words(*words.text_bytes(pa.array(texts, pa.string())), table)
            expected = [brute.words(t, pattern) for t in texts]
            assert counts.tolist() == [len(w) for w in expected]
            seen = dict(zip([w for ws in expected for w in ws], hashes.tolist()))
            assert [seen[w] for ws in expected for w in ws] == hashes.tolist() and len(set(seen.values())) == len(seen)
    finally:
        words.BLOCK = whole


@pytest.mark.parametrize("most", [1 << 20, 4])
def test_components_of_paths_and_stars(shared, monkeypatch, most):
    monkeypatch.setattr(component_lists, "TASK_EDGES", most)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(3, 3), (None, 4)]
    found = {r["node"]: r["root"] for r in rows(components(shared.createDataFrame(edges, "a long, b long"), "test"))}
    assert found == {**dict.fromkeys(range(100, 141), 100), **dict.fromkeys(range(7, 60), 7)}


def test_stars_of_random_edges_reach_the_smallest_node():
    rng = np.random.default_rng(8)
    for n in (1, 5, 300):
        a, b = rng.integers(-n, n, (2, 2 * n))
        a, b = a[a != b], b[a != b]
        root = {x: x for x in [*a.tolist(), *b.tolist()]}
        for _ in root:
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                root[x] = root[y] = min(root[x], root[y])
        found = dict(zip(*(side.tolist() for side in component_lists.stars(a, b)), strict=True))
        assert found == {x: r for x, r in root.items() if x != r}


# 1 Chat formatting

@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>\\[]/|sINTu_imstar", max_size=30))
def test_escape_pattern_is_reversible(text):
    import re

    text += "</s>\\[/INST]<|im_end|>"
    java = lambda r: r.replace(r"\\", "\\\\").replace("$", "\\")
    up = re.sub(rf"\[(\\*)({chat._SQUARE})", java(r"[\\$1$2"), re.sub(rf"<(\\*)({chat._ANGLE})", java(r"<\\$1$2"), text))
    down = re.sub(rf"<\\(\\*)({chat._ANGLE})", java("<$1$2"), re.sub(rf"\[\\(\\*)({chat._SQUARE})", java("[$1$2"), up))
    assert down == text
    assert not any(c in up for c in (chat.START, chat.SEP, chat.END, "</s>", "[INST]", "[/INST]", "<<SYS>>"))


TURNS = [
    (1, 0, "system", "be <|im_end|> kind"), (1, 1, "user", "hi\n"), (1, 2, "assistant", "a <\\/s> b"), (1, 3, "user", None), (1, 4, "assistant", "</s>[INST]"),
    (2, 0, "user", "alone"), (3, 0, "assistant", ""), (None, None, None, None), (4, 0, "assistant", "x"), (4, 0, "assistant", "x"), (4, None, "us\ner", "first"),
]


def test_prefix_targets_round_trip(shared):
    turns = shared.createDataFrame([(*t, "e") for t in TURNS], "conv_id long, turn long, role string, text string, id string")
    examples = rows(chat.prefix_targets(turns))
    by = defaultdict(list)
    for t in TURNS:
        by[t[0]].append((t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
    assert Counter(e["conv_id"] for e in examples) == {1: 2, 2: 1, 3: 1, None: 1, 4: 2}
    for e in examples:
        assert e["formatted"].count(chat.END) == e["context_turns"] + (e["target"] is not None)
    found = {r["conv_id"]: r for r in rows(chat.digests(chat.prefix_targets(turns)))}
    for conv, said in by.items():
        said.sort()
        loss = "".join(t[3] for t in said if t[2] == "assistant")
        r = found[conv]
        assert r["n_turns"] == len(said) and r["turns_sha256"] == brute.sha("".join(f"{t[2]}\n{t[3]}\n" for t in said))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), brute.sha(loss))
        assert r["formatted_chars"] == sum(len(e["formatted"]) for e in examples if e["conv_id"] == conv)
    assert rows(chat.digests(chat.prefix_targets(turns.where("false")))) == []


# 2 Token counts

def test_token_counts_equal_the_library(shared, documents, odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    extra = ["a <|endoftext|>  b", "<|endoftext|>", "  lead", "trail  ", "a b  c", "it's  we'll\n\n\nx", "tab\t\t1 2", "\x1c a\x85b", "nbsp   x"]
    more = shared.createDataFrame([(100_000 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")
    for docs in (documents.select("doc_id", "text"), odd.select("doc_id", "text"), more):
        texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
        expected = [{"doc_id": i, "n_bytes": len(t.encode()), "n_tokens": n, "over_limit": n > 512}
                    for i, t in texts for n in [len(tokenizer.encode(t, add_special_tokens=False))]]
        assert ordered(rows(token_counts.token_counts(docs, path))) == ordered(expected)
    assert rows(token_counts.token_counts(none, path)) == []


def test_token_counts_of_long_texts_in_stretches(monkeypatch):
    import public_tokenizers

    lengths = token_counts.Lengths(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["the  quick\n\n brown fox's " * 50, "y" * 90 + " z", ""]
    whole = [len(lengths.tokenizer.encode(t, add_special_tokens=False)) for t in texts]
    monkeypatch.setattr(token_counts, "LONG", 17)
    monkeypatch.setattr(token_counts, "KNOWN", 5)
    assert lengths.count(texts) == whole


# 3 Line dedup

def test_site_boilerplate(shared):
    menu = "<nav><li>Home</li></nav>"
    pages = [(i, f"http://User@Big.example.org:80/{i}", f"<html>{menu}<p>Text {i}<p>Text {i}<script>x</script><!-- c --></html>") for i in range(9)]
    pages += [(20, "http://small.example.org/", f"{menu}<p>one"), (21, None, "<p>no host"), (22, "junk", None), (22, "junk", None), (None, "http://big.example.org", "")]
    frame = shared.createDataFrame([(*p, "c") for p in pages], "page_id long, url string, html string, host string")
    found = defaultdict(list)
    for r in rows(line_dedup.without_boilerplate(frame)):
        found[r["page_id"]].append(r)
    assert [found[i][0]["text"] for i in range(9)] == [f"Text {i}\nText {i}" for i in range(9)]
    assert found[0][0]["n_dropped"] == 1 and found[0][0]["host_pages"] == 10 and found[0][0]["host"] == "big.example.org"
    assert found[20][0]["text"] == "Home\none" and found[21][0]["host_pages"] == 3 and len(found[22]) == 2
    assert rows(line_dedup.without_boilerplate(frame.where("false"))) == []


# 4 Language model

def test_bigram_model_scores(shared, documents):
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    found = {r["doc_id"]: r for r in rows(pitman_yor.scored(documents, held))}
    texts = {r["doc_id"]: brute.words(r["text"]) + ["\0end"] for r in documents.collect()}
    counts = Counter(w for i, t in texts.items() if brute.crc(str(i)) % 5 != 1 for w in t)
    n, v = sum(counts.values()), len(counts)
    assert set(found) == set(texts)
    for i, tokens in texts.items():
        r = found[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (brute.crc(str(i)) % 5 == 1, len(tokens), n)
        assert r["n_known"] == sum(counts[w] > 0 for w in tokens)
        assert r["base_score"] == pytest.approx(sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens))
    out = [r for r in found.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_probabilities_sum_to_one(shared):
    docs = shared.createDataFrame([(1, "a b a b c a b"), (2, "b a c"), (3, "a a a")], "doc_id long, text string")
    plain = docs.select(F.col("doc_id").alias("key"), "text")
    total, hot = pitman_yor.frequent_tokens(plain, "text")
    packed = plain.select("text").mapInArrow(pitman_yor._bigrams("text", hot, 1), "bucket int, tokens binary, ends binary, contexts binary, counts binary")
    customers = packed.groupBy("bucket").applyInArrow(pitman_yor._merged, "bucket int, tokens binary, ends binary, contexts binary, counts binary")
    model = pitman_yor.trained(customers, hot[:0], 4, 5, 3)
    (row,) = customers.collect()
    bucket = pitman_yor.Bucket(*row)
    for i, (tables, sent, above) in enumerate(bucket.replay(model, 5, 3, 1), 1):
        state = model.rounds[i]
        assert state["customers"] == sent.sum() and state["tables"] == above.sum() and (tables <= bucket.counts).all() and (tables >= 1).all()
        parent = model.parent(sent, above, state)
        assert parent.sum() + model.parent(0.0, 0.0, state) == pytest.approx(1)
        for context in set(bucket.contexts):
            own = bucket.contexts == context
            p = model.child(0, 0, np.full(len(parent), context), parent, state)
            p[bucket.word[own]] = model.child(bucket.counts[own], tables[own], bucket.contexts[own], parent[bucket.word[own]], state)
            rest = float(model.child(0, 0, np.array([context]), np.array([model.parent(0.0, 0.0, state)]), state)[0])
            assert p.sum() + rest == pytest.approx(1)


def test_rounds_go_on_from_the_stored_seating(shared):
    """A round's table has each bucket's seating, so none is drawn twice, and only the first one has hashes."""
    docs = shared.createDataFrame([(i, f"a b a{i % 7} b c a{i % 3} b") for i in range(60)], "doc_id long, text string")
    kind = "bucket int, tokens binary, ends binary, contexts binary, counts binary"
    packed = docs.select("text").mapInArrow(pitman_yor._bigrams("text", np.empty(0, np.uint64), 3), kind)
    customers = packed.groupBy("bucket").applyInArrow(pitman_yor._merged, kind)
    model = pitman_yor.trained(customers, np.empty(0, np.uint64), 12, 5, 3)
    buckets = {r["bucket"]: pitman_yor.Bucket(*r) for r in customers.collect()}
    for i in range(4):
        stored = model.rounds[i]["by_context"].table.collect()
        assert any(r["bucket"] < 0 and len(r["contexts"]) for r in stored) == (i == 0)
        seats = {r["bucket"]: pitman_yor.unpacked(r["sums"], np.uint32).tolist() for r in stored if r["part"] < -1}
        assert seats == ({b: own.replay(model, 5, i, i)[0][0].tolist() for b, own in buckets.items()} if i else {})


def test_packed_arrays():
    rng = np.random.default_rng(3)
    for kind, high in ((np.uint16, 1 << 16), (np.uint32, 1 << 32), (np.int64, 1 << 62), (np.uint64, (1 << 64) - 1)):
        for n in (0, 1, 1000):
            values = rng.integers(0, high, n, dtype=kind)
            assert pitman_yor.unpacked(pitman_yor.packed(values), kind).tolist() == values.tolist()
            if kind is not np.int64:
                assert pitman_yor.unpacked_rising(pitman_yor.packed_rising(np.sort(values)), kind).tolist() == sorted(values.tolist())
    contexts = rng.integers(0, 50, 300, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    distinct, number = pitman_yor.unpacked_contexts(pitman_yor.packed_contexts(contexts))
    assert distinct[number].tolist() == contexts.tolist() and len(distinct) == 50


@pytest.mark.parametrize("pair", [False, True])
def test_each_context_is_a_restaurant_of_its_own(shared, documents, pair):
    """Before the first round all dishes have one table, so the scores follow from counts alone."""
    docs = documents.select("doc_id", "text")
    if pair:  # one very common pair, scored from the shared table
        docs = docs.unionByName(shared.createDataFrame([(10_000 + i, "so zu " * 200) for i in range(20)], "doc_id long, text string"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    texts = {r["doc_id"]: ["\0start"] + brute.words(r["text"]) + ["\0end"] for r in docs.collect()}
    train = Counter(p for i, t in texts.items() if brute.crc(str(i)) % 5 != 1 for p in zip(t, t[1:]))
    customers, sent, total, tables = Counter(), Counter(), Counter(), Counter()
    for (before, word), n in train.items():
        customers[word] += n
        sent[word] += 1
        total[before] += n
        tables[before] += 1
    ratio = lambda c: min(0.9, max(0.1, (one := sum(n == 1 for n in c.values())) / max(1, one + 2 * sum(n == 2 for n in c.values()))))
    _, hot = pitman_yor.frequent_tokens(docs, "text")
    names = words_by_hash([w for t in texts.values() for w in t[1:-1]])
    cold = {w: n for w, n in sent.items() if w not in {names.get(h, "\0end") for h in hot.tolist()}}
    d, above, s, v = ratio(train), ratio(cold), 1.0, len(customers)

    def p(before, word):
        parent = (sent[word] - above * (word in sent) + (s + above * v) / (v + 1)) / (s + sum(sent.values()))
        return (max(0, train[before, word] - d) + (s + d * tables[before]) * parent) / (s + total[before]) if total[before] else parent

    found = {r["doc_id"]: r["score"] for r in rows(pitman_yor.scored(docs, held, rounds=0))}
    expected = {i: sum(np.log10(p(*x)) for x in zip(t, t[1:])) for i, t in texts.items()}
    assert found == pytest.approx(expected, rel=1e-9)


def words_by_hash(texts):
    import pyarrow as pa

    distinct = sorted(set(texts))
    hashes, _ = words.hash_words(*words.text_bytes(pa.array(distinct, pa.string())), words.NOT_SPACE)
    return dict(zip(hashes.tolist(), distinct, strict=True))


def test_tables_follow_their_conditional_distribution():
    d, strength, base, others, c = 0.6, 1.0, 0.2, 3.0, 6
    table = pitman_yor.log_stirling(d, pitman_yor.EXACT)
    logs = np.array([table[c, t] + np.log([(strength + d * (others + k)) * base for k in range(t)]).sum() for t in range(1, c + 1)])
    expected = np.exp(logs - logs.max())
    expected /= expected.sum()
    n = 200_000
    drawn = pitman_yor.draw_tables(np.random.default_rng(1), np.full(n, c), np.full(n, others), np.full(n, base), d, strength, table)
    assert np.bincount(drawn, minlength=c + 1)[1:] / n == pytest.approx(expected, abs=0.005)
    # ways to seat 3 customers: one table, three pairs and a single, three singles
    assert np.exp(table[3, 1:4]) == pytest.approx([(1 - d) * (2 - d), 3 * (1 - d), 1])


def test_tables_of_large_dishes_are_near_one_by_one_seating():
    rng, c, n = np.random.default_rng(2), 3000, 400
    d, strength, others, base = 0.7, 1.0, 50.0, 0.05
    fast = pitman_yor.draw_tables(rng, np.full(n, c), np.full(n, others), np.full(n, base), d, strength, pitman_yor.log_stirling(d, pitman_yor.EXACT))
    t = np.ones(n)
    for i in range(1, c):
        fresh = (strength + d * (others + t)) * base
        t += rng.random(n) < fresh / (fresh + i - d * t)
    assert fast.mean() == pytest.approx(t.mean(), rel=0.05)


def test_odd_rows_have_scores(odd, none):
    found = rows(pitman_yor.scored(odd, F.col("doc_id") == 9))
    assert len(found) == len(ODD) and all(np.isfinite(r["score"]) and r["score"] < 0 for r in found)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in found) == Counter((r[0], len(brute.words(r[1])) + 1) for r in ODD)
    assert rows(pitman_yor.scored(none, F.lit(False))) == []
    assert all(r["n_known"] == 0 for r in rows(pitman_yor.scored(odd, F.lit(True))))


# 5 Decontamination

ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"), (2, "Short item"), (3, None), (4, "..."), (2, "short item"), (10, "a a a")]


def test_contamination_equals_brute_force(shared, documents, monkeypatch):
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    extra = [(1000, "x " + base + ", y"), (1001, base.replace("seven", "7")), (1002, "SHORT-item! short item"), (1003, "short"), (1004, "item"), (1005, "a a a a b a a"), (1006, None), (1006, " "),
             (None, base.upper()), (1007, ("w " * 700) + base)]
    docs = documents.select("doc_id", "text").unionByName(shared.createDataFrame(extra, "doc_id long, text string"))
    items = shared.createDataFrame(ITEMS, "item_id long, text string").unionByName(shared.read.parquet(f"{FOLDER}/benchmark.parquet"))
    listed = [(r[0], r[1]) for r in items.collect()]
    expected = []
    for r in docs.collect():
        n, hit, found = brute.contamination(r["text"], listed)
        expected.append((r["doc_id"], n, hit, ",".join(found), hit > 0 and 20 * hit >= n))
    key = lambda x: str(x)
    for words_a_slice, starts in ((decontaminate.SLICE_WORDS, decontaminate.STARTS), (150, 7)):
        monkeypatch.setattr(decontaminate, "SLICE_WORDS", words_a_slice)
        found = decontaminate.contamination(decontaminate.benchmark_matches(docs, items))
        got = [(r["doc_id"], r["n_words"], r["n_hit"], ",".join(r["items"]), r["contaminated"]) for r in found.collect()]
        assert sorted(got, key=key) == sorted(expected, key=key)
        monkeypatch.setattr(decontaminate, "STARTS", starts)


def test_candidate_starts_in_turns(monkeypatch):
    monkeypatch.setattr(decontaminate, "STARTS", 3)
    terms = np.array([5, 9], np.uint64)
    windows = decontaminate.Windows(["i"], [np.array([5, 9], np.uint64)])
    segment = decontaminate.Segment(windows, np.array([40], np.uint32).tobytes(), terms.tobytes(), np.array([20, 40], np.uint32).tobytes(),
                                    np.r_[np.arange(0, 40, 2), np.arange(1, 40, 2)].astype(np.uint32).tobytes())
    found = [tuple(map(int, (a, b))) for _, low, high, _ in segment.matches(windows.by_width[2][0], 0) for a, b in zip(low, high)]
    assert found == [(i, i + 2) for i in range(0, 40, 2)]


def test_proximity_matches(shared):
    docs = shared.createDataFrame([(1, "p alpha beta q gamma r"), (2, "alpha beta gamma"), (3, "gamma x x x x alpha beta"), (4, "alpha beta")], "doc_id long, text string")
    items = shared.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string")
    found = {r["doc_id"]: [(s["start"], s["end"], s["exact"]) for s in r["spans"]] for r in decontaminate.benchmark_matches(docs, items, slack=1).collect()}
    assert found == {1: [(1, 5, False)], 2: [(0, 3, True)], 3: [], 4: []}


def test_decontaminated_keeps_columns(odd, none):
    items = odd.sparkSession.createDataFrame([(1, "two words")], "item_id long, text string")
    assert ordered(rows(decontaminate.decontaminated(odd, items))) == ordered(r for r in rows(odd) if r["text"] != "two words")
    assert ordered(rows(decontaminate.decontaminated(odd, items.where("false")))) == ordered(rows(odd))
    assert rows(decontaminate.decontaminated(none, items)) == []


def test_a_third_of_the_rows_under_no_key_loses_only_contaminated_ones(shared):
    items = shared.createDataFrame([(1, "two words")], "item_id long, text string")
    texts = [f"text number {i} of many" if i % 7 else "two words" for i in range(300)]
    docs = shared.createDataFrame([(i if i % 3 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert ordered(rows(decontaminate.decontaminated(docs, items))) == ordered(r for r in rows(docs) if r["text"] != "two words")


# 6 Sharding

@pytest.mark.parametrize("part_rows", [10, 50_000])
def test_shards_match_the_mixture(documents, part_rows):
    found = rows(sharding.stratified_shards(documents, part_rows=part_rows))
    texts = {r["doc_id"]: r for r in documents.collect()}
    assert len(found) == len(texts)
    for r in found:
        text = texts[r["doc_id"]]["text"]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text.encode()) + 8, brute.crc(text), "rows", None)
    by = defaultdict(list)
    for r in found:
        by[r["shard"]].append(r)
    assert set(by) == set(range(24)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(r["slot"] for r in own) == list(range(len(own))) for own in by.values())
    sources = Counter(r["source"] for r in texts.values())
    for own in by.values():
        mine = Counter(texts[r["doc_id"]]["source"] for r in own)
        assert all(abs(mine[s] - n / 24) < 2 for s, n in sources.items())


def test_many_sources_of_one_row_are_spread(shared):
    docs = shared.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("text").alias("text"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("only"), "id")).otherwise(F.lit("large")).alias("source"))
    found = Counter(r["shard"] for r in rows(sharding.stratified_shards(docs, shards=10)) if r["doc_id"] % 3 == 0)
    assert sum(found.values()) == 1000 and all(60 <= found[i] <= 140 for i in range(10))


def test_shards_of_odd_rows(odd, none):
    found = rows(sharding.stratified_shards(odd, shards=5))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter((r[0], len((r[1] or "").encode()) + 8, brute.crc(r[1])) for r in ODD)
    assert sorted(Counter(r["shard"] for r in found).values()) == [2, 2, 2, 3, 3]
    assert rows(sharding.stratified_shards(none)) == []


# 7 Exact dedup

def test_filters_merge_without_loss():
    rng = np.random.default_rng(3)
    parts = [rng.integers(0, 1 << 64, 500, dtype=np.uint64) for _ in range(4)] + [np.array([0, 5, (1 << 64) - 1], np.uint64)] * 2
    packed = []
    for p in parts:
        prints, counts = np.unique(p, return_counts=True)
        again = exact_dedup.unpacked_runs(*exact_dedup.packed_runs(prints, counts))
        assert (again[0] == prints).all() and (again[1] == counts).all()
        packed.append(again)
    prints, counts = exact_dedup.merged(packed)
    assert dict(zip(prints.tolist(), counts.tolist())) == Counter(x for p in parts for x in p.tolist())


def test_odd_rows_in_groups_of_equal_texts(odd, none):
    found = rows(exact_dedup.duplicate_groups(odd))
    bare = lambda t: exact_dedup.stripped(t).decode()
    groups = defaultdict(list)
    for r in ODD:
        groups[bare(r[1])].append(r)
    expected = Counter()
    for text, own in groups.items():
        best = max(own, key=lambda r: (len(r[1] or ""), r[0] is not None, -(r[0] or 0)))
        expected.update((r[0], best[0], len(own), brute.sha(text)) for r in own)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == expected
    assert sum(r["kept"] for r in found) == len(groups)
    kept = rows(exact_dedup.without_duplicates(odd))
    assert len(kept) == len(groups) and {bare(r["text"]) for r in kept} == set(groups) and list(kept[0]) == odd.columns
    assert rows(exact_dedup.duplicate_groups(none)) == [] and rows(exact_dedup.without_duplicates(none)) == []


# 8 Jaccard join

@pytest.mark.parametrize(("n", "num", "den", "block"), [(4, 85, 100, 1024), (5, 4, 5, 1024), (3, 1, 2, 1024), (4, 85, 100, 2)])
def test_components_equal_brute_force(documents, n, num, den, block):
    texts = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    roots, sets = brute.components([t for _, t in texts], n, num, den)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(jaccard_join.similarity_classes(documents, words=n, num=num, den=den, block_classes=block))}
    assert found == {texts[i][0]: (len(sets[i]), texts[roots[i]][0]) for i in range(len(texts))}


def families(seed, bases, copies, size):
    """Texts with edits of all sizes around the limit, many of them short."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(bases):
        base = [f"w{x}" for x in rng.integers(0, 400, size)]
        for _ in range(copies):
            own = list(base)
            for _ in range(int(rng.integers(0, max(2, size // 12)))):
                at = int(rng.integers(0, len(own)))
                own[at:at + int(rng.integers(0, 2))] = [f"v{rng.integers(0, 50)}"] * int(rng.integers(0, 3))
            out.append(" ".join(own))
    return out


@pytest.mark.parametrize("block", [1024, 5])
def test_families_around_the_limit(shared, block):
    texts = [t for size in (5, 9, 14, 25, 60, 200) for t in families(size, 4, 12, size)] + ["", None, "a", "a", "a b"]
    roots, sets = brute.components(texts, 4, 85, 100)
    docs = shared.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(jaccard_join.similarity_classes(docs, words=4, num=85, den=100, block_classes=block))}
    assert found == {i: (len(sets[i]), roots[i]) for i in range(len(texts))}


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 400), st.integers(0, 40))
def test_linked_sets_share_a_first_member(seed, size, edits):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
    b = np.unique(np.r_[a[rng.permutation(len(a))[min(edits // 2, len(a) - 1):]], rng.integers(0, 1 << 64, edits - edits // 2, dtype=np.uint64)])
    listed = rng.permutation(np.unique(np.r_[a, b]))[:int(rng.integers(0, 2 * size))]
    order = jaccard_join.Order(listed, rng.integers(4, 9, len(listed)))
    for num, den in ((85, 100), (4, 5), (1, 2)):
        common = len(np.intersect1d(a, b))
        if den * common >= num * (len(a) + len(b) - common):
            x, y = (set(order.prefix(s, (s % np.uint64(3)).astype(np.uint16), num, den)[0].tolist()) for s in (a, b))
            assert x & y


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 600), st.integers(0, 60), st.integers(0, 60))
def test_linked_sets_share_as_many_first_members_as_stated(seed, size, only_a, only_b):
    rng = np.random.default_rng(seed)
    a, b = (np.unique(np.r_[rng.permutation(np.arange(1, size + 1, dtype=np.uint64)), rng.integers(1 << 20, 1 << 63, k, dtype=np.uint64)]) for k in (only_a, only_b))
    both = np.unique(np.r_[a, b])
    level = {m: int(x) for m, x in zip(both.tolist(), rng.integers(0, 9, len(both)), strict=True)}
    listed = rng.permutation(both)[:int(rng.integers(0, len(both)))]
    order = jaccard_join.Order(listed, rng.integers(4, 9, len(listed)))
    for num, den in ((85, 100), (4, 5), (1, 2), (1, 80)):
        if den * len(np.intersect1d(a, b)) >= num * len(both):
            x, y = (order.prefix(s, np.array([level[m] for m in s.tolist()], np.uint16), num, den)[0] for s in (a, b))
            assert len(np.intersect1d(x, y)) >= int(jaccard_join.least_shared(len(a), len(b), num, den)) >= 1


def test_pairs_of_lists_are_counted(monkeypatch):
    rng = np.random.default_rng(3)
    size = rng.integers(50, 100, 30)
    lists = [sorted(rng.permutation(30)[:int(rng.integers(1, 12))].tolist(), key=lambda i: (size[i], i)) for _ in range(40)]
    expected = Counter((x, y) for own in lists for i, x in enumerate(own) for y in own[i + 1:] if 100 * size[x] >= 85 * size[y])
    owner = np.array([x for own in lists for x in own], np.int64)
    ends = np.repeat(np.cumsum([len(own) for own in lists]), [len(own) for own in lists])
    for together in (4_000_000, 7):
        monkeypatch.setattr(jaccard_join, "PAIRS_TOGETHER", together)
        pairs, counts = jaccard_join._pairs_of_lists(owner, size[owner], ends, 85, 100)
        assert expected == {(p >> 32, p & 0xFFFFFFFF): n for p, n in zip(pairs.tolist(), counts.tolist(), strict=True)}


@pytest.mark.parametrize("paired", [1, 3, 64])
def test_texts_with_a_phrase_in_common_do_not_meet(shared, monkeypatch, paired):
    """A chain of texts, each with a rare phrase of the next, is no cluster; near copies are, however their members are routed."""
    rng = np.random.default_rng(5)
    common = [[f"w{x}" for x in rng.integers(0, 2000, 288)] for _ in range(40)]
    phrase = [[f"p{i}x{j}" for j in range(6)] for i in range(41)]
    texts = [" ".join(phrase[i] + common[i] + phrase[i + 1]) for i in range(40)]
    texts += [texts[i].replace(common[i][150], "other", 1) for i in (4, 20, 20, 33)] + [texts[20] + " more"]
    wanted = []
    with_texts = jaccard_join._with_texts
    monkeypatch.setattr(jaccard_join, "_with_texts", lambda units, plain: wanted.append(units.count()) or with_texts(units, plain))
    monkeypatch.setattr(jaccard_join, "PAIRED", paired)
    docs = shared.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in rows(jaccard_join.similarity_classes(docs, words=4, num=85, den=100))}
    roots, _ = brute.components(texts, 4, 85, 100)
    assert found == dict(enumerate(roots)) and sum(i != r for i, r in enumerate(roots)) == 5
    if paired == 64:  # of the three groups, one each of equal sets
        assert wanted == [7]


def test_very_frequent_members_are_spread(documents, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SALT_SETS", 3)
    monkeypatch.setattr(jaccard_join, "TOGETHER", 5_000)
    monkeypatch.setattr(jaccard_join, "MIN_COUNT", 2)
    texts = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    roots, _ = brute.components([t for _, t in texts], 4, 3, 5)
    found = {r["doc_id"]: r["component_id"] for r in rows(jaccard_join.similarity_classes(documents, words=4, num=3, den=5))}
    assert found == {texts[i][0]: texts[roots[i]][0] for i in range(len(texts))}


def test_odd_rows_in_the_join(odd, none):
    found = rows(jaccard_join.similarity_classes(odd))
    roots, sets = brute.components([r[1] for r in ODD], 5, 4, 5)
    assert sorted(str((r["doc_id"], r["n_shingles"])) for r in found) == sorted(str((r[0], len(s))) for r, s in zip(ODD, sets))
    assert {r["component_id"] for r in found if r["doc_id"] in (1, 2)} == {1}
    assert {r["component_id"] for r in found if r["n_shingles"] == 1 and r["doc_id"] in (6, None)} == {6}
    kept = rows(jaccard_join.one_of_each(odd))
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(map(str, [1, 3, 4, 5, 6, 7, 8, 9, None]))  # the null key of the empty text
    assert rows(jaccard_join.similarity_classes(none)) == [] and rows(jaccard_join.one_of_each(none)) == []


# 9 Packing

def test_bounds_are_optimal():
    from itertools import combinations

    rng = np.random.default_rng(4)
    for _ in range(30):
        lengths = np.sort(rng.choice(60, 9, replace=False) + 1).astype(float)
        counts = rng.integers(1, 30, 9)
        cost = lambda bounds: sum(c * min(b for b in bounds if b >= x) for x, c in zip(lengths, counts))
        for k in (1, 3, 9, 12):
            best = min(cost([*pick, lengths[-1]]) for pick in combinations(lengths[:-1], min(k, 9) - 1))
            found = packing.optimal_bounds(lengths, counts, k)
            assert len(found) <= k and cost(found) == best


def test_one_long_text_leaves_the_other_bounds(shared, monkeypatch):
    lengths = [1 + (i * i * 7919) % 3001 for i in range(600)] + [50_000_000]
    frame = shared.createDataFrame([(x,) for x in lengths], "n long")
    count = Counter(lengths)
    distinct = sorted(count)
    upto = np.concatenate([[0], np.cumsum([count[x] for x in distinct])])
    cost = [0.0] + [float("inf")] * len(distinct)
    for _ in range(4):
        cost = [0.0] + [min(cost[i] + distinct[j - 1] * (upto[j] - upto[i]) for i in range(j)) for j in range(1, len(cost))]
    padded = lambda bounds: sum(min(b for b in bounds if b >= x) for x in lengths)
    bounds = packing.length_bounds(frame, "n", 4)
    assert len(bounds) == 4 and padded(bounds) == cost[-1]
    monkeypatch.setattr(packing, "LENGTHS", 100)
    with pytest.raises(ValueError, match="distinct lengths"):
        packing.length_bounds(frame, "n", 4)


@pytest.mark.parametrize("part_rows", [10, 50_000])
def test_packed_batches(documents, odd, none, part_rows):
    for docs in (documents, odd):
        found = rows(packing.packed(docs, budget=20_000, buckets=4, part_rows=part_rows))
        assert Counter((r["doc_id"], r["n_tokens"]) for r in found) == Counter((r["doc_id"], len((r["text"] or "").encode()) + 1) for r in docs.collect())
        batches = defaultdict(list)
        for r in found:
            assert r["n_tokens"] + r["padding"] == r["padded"] and r["padding"] >= 0
            batches[r["bucket"], r["batch"]].append(r)
        last = {b: max(k[1] for k in batches if k[0] == b) for b, _ in batches}
        for (bucket, batch), own in batches.items():
            room = max(1, 20_000 // own[0]["padded"])
            assert sorted(r["slot"] for r in own) == list(range(len(own))) and len(own) <= room
            assert len(own) == room or batch == last[bucket]
    assert rows(packing.packed(none)) == []


# 10 Language

def test_language_of_held_out_rows(documents):
    train = documents.where("doc_id % 2 = 0")
    languages, model = language.text_model(train, "doc_id", "text", "lang")
    rest = language.evidence_of_documents(documents.where("doc_id % 2 = 1")).withColumn("true", F.col("declared")).withColumn("declared", F.lit(None).cast("string"))
    found = rows(language.fused(rest, languages, model))
    right = [r for r in found if r["true"] == r["lang_found"]]
    assert languages == ["de", "en", "es", "fr"] and len(right) / len(found) > 0.97
    assert sum(r["accepted"] for r in found) / len(found) > 0.99


def test_evidence_decides_where_the_text_does_not(shared, documents):
    languages, model = language.text_model(documents, "doc_id", "text", "lang")
    sure = [(r["doc_id"], r["text"], r["lang"], "tld-" + r["lang"], "host-" + r["lang"]) for r in documents.collect()]
    kind = "id long, text string, declared string, suffix string, host string"
    asked = [(-1, "de", "fr", None, None), (-2, "de", None, "tld-es", None), (-3, "de", None, None, "host-fr"), (-4, "1 2 3", "fr", "tld-fr", "host-fr"), (-5, "", None, None, None), (-6, "", "", "", "")]
    found = {r["id"]: r for r in rows(language.fused(shared.createDataFrame(sure + asked, kind), languages, model)) if r["id"] < 0}
    assert [found[-i]["lang_found"] for i in (1, 2, 3)] == ["fr", "es", "fr"]
    assert not any(found[-i]["accepted"] for i in (4, 5, 6)) and found[-4]["lang_found"] == "fr"


def test_junk_is_rejected_and_odd_rows_have_a_result(documents, odd, none):
    found = rows(language.in_known_language(documents))
    assert len(found) >= 0.98 * documents.count() and set(documents.columns) == set(found[0])
    languages, model = language.text_model(documents, "doc_id", "text", "lang")
    judged = rows(language.fused(language.evidence_of_documents(odd), languages, model))
    assert len(judged) == len(ODD) and all(0 <= r["confidence"] <= 1 for r in judged)
    assert {r["id"] for r in judged if not r["accepted"]} >= {3, 4, 5}
    assert list(language.in_known_language(odd).columns) == odd.columns and rows(language.in_known_language(none)) == []


def test_rows_that_share_a_key_are_judged_one_by_one(shared, documents):
    good = documents.select("text", "lang", "source").limit(40).withColumn("doc_id", F.when(F.col("lang") == "en", F.lit(1).cast("long")))
    junk = shared.createDataFrame([("1 2 3", "en", "x", None), ("", None, "x", 1), (None, None, None, None)], good.schema)
    found = rows(language.in_known_language(good.unionByName(junk)))
    assert {r["text"] for r in found} <= {r["text"] for r in good.collect()} and len(found) >= 0.9 * good.count()


def test_host_priors_are_smoothed_upwards(shared, documents):
    """A new host of a suffix leans to the suffix's language, an old one to its own."""
    languages, model = language.text_model(documents, "doc_id", "text", "lang")
    texts = defaultdict(list)
    for r in documents.collect():
        texts[r["lang"]].append(r["text"])
    sites = [(i, t, None, "ch", "fr.ch") for i, t in enumerate(texts["fr"][:20])] + [(100 + i, t, None, "ch", f"de{i}.ch") for i, t in enumerate(texts["de"][:20])]
    asked = [(-1, "on", None, "ch", "fr.ch"), (-2, "on", None, "ch", "new.ch")]
    kind = "id long, text string, declared string, suffix string, host string"
    found = {r["id"]: r["lang_found"] for r in rows(language.fused(shared.createDataFrame(sites + asked, kind), languages, model))}
    assert found[-1] == "fr" and found[-2] in ("de", "fr")


def test_rare_languages_and_null_keys_are_fitted(shared):
    """One text in about 20,000 of a language of its own, with and without keys."""
    rare = "zxq vwx qqz xwv zvq wxz " * 20
    common = ["the cat sat on the mat with the hat " * 3, "le chat est sur la table avec le chien " * 3]
    texts = [(i, common[i % 2], ("en", "fr")[i % 2]) for i in range(20_000)] + [(20_001, rare, "zz"), (20_002, None, "yy")]
    docs = shared.createDataFrame(texts, "id long, text string, lang string").repartition(3)
    for keys in (F.col("id"), F.lit(None).cast("long")):
        languages, model = language.text_model(docs.withColumn("id", keys), "id", "text", "lang")
        assert languages == ["en", "fr", "yy", "zz"]
    counted = Counter()
    for _, text, lang in texts:
        if lang == "en":
            number, own = language.trigrams(np.frombuffer(text.encode(), np.uint8))
            counted.update(number[own].tolist())
    total = sum(counted.values()) + 0.1 * language.FEATURES
    assert model[0] == pytest.approx(np.log((np.array([counted[i] for i in range(language.FEATURES)]) + 0.1) / total), rel=1e-5)
    asked = shared.createDataFrame([(-1, rare, None, None, None), (-2, common[0], None, None, None)], "id long, text string, declared string, suffix string, host string")
    found = {r["id"]: (r["lang_found"], r["accepted"]) for r in rows(language.fused(asked, languages, model))}
    assert found == {-1: ("zz", True), -2: ("en", True)}


def test_every_operator_has_its_query():
    assert [q.split("_")[0] for q in queries.QUERIES] == [*(f"op{i}" for i in range(1, 11)), "pipeline"]
