"""Operators against brute force, exact round trips and held-out accuracy."""

import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import compare
from gleaner.llm import (blocks, contamination, grace, hashing, language, lines, near, packing, passages, quality,
                         substrings, suffixes, warc)
from gleaner.llm.components import components
from gleaner.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]


def shingle_set(text, n):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(small):
    return {r["doc_id"]: r["text"] for r in small.select("doc_id", "text").collect()}


def closed(links, nodes):
    up = {i: i for i in nodes}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in nodes}


@given(st.text(alphabet=" \t\nABCxyzé", max_size=200), st.integers(1, 4))
@settings(max_examples=200, deadline=None)
def test_words_and_shingles(text, n):
    h, start, end = list(hashing.words([b"other text", text.encode(), b"more"]))[1]
    raw = text.encode()
    assert [raw[a:b].decode().translate({c: c + 32 for c in range(65, 91)}) for a, b in zip(start, end)] == words(text)
    assert len(hashing.shingles(h, n)) == len(shingle_set(text, n))


def test_long_texts_hash_like_short_ones(monkeypatch):
    text = " ".join(f"w{i % 50}" for i in range(5000)).encode()
    whole = next(hashing.words([text]))
    monkeypatch.setattr(hashing, "CHUNK", 1000)
    for a, b in zip(whole, next(hashing.words([text]))):
        assert (a == b).all()


@given(st.lists(st.integers(1, 4), max_size=80))
@settings(max_examples=300, deadline=None)
def test_suffix_arrays(symbols):
    t = np.array(symbols + [0], dtype=np.uint16)
    sa = suffixes.suffix_array(t, 5, 10**6).tolist()
    assert sa == sorted(range(len(t)), key=lambda i: (symbols + [0])[i:])
    common = suffixes.permuted_prefixes(t, np.array(sa, dtype=np.int32), 6)
    for a, b in zip(sa, sa[1:]):
        n = 0
        while n < 6 and a + n < len(t) and b + n < len(t) and t[a + n] == t[b + n]:
            n += 1
        assert common[b] == n


@pytest.mark.parametrize("n, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, small, texts, n, percent):
    sets = {i: shingle_set(t, n) for i, t in texts.items()}
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] and
             100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    want = closed(links, sets)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near.near_duplicates(small, n, percent).collect()}
    assert links and got == {i: (len(s), want[i]) for i, s in sets.items()}


def test_near_blocks(spark, monkeypatch):
    """Links between members of which none links with the leader of a bucket are found, in several blocks too."""
    monkeypatch.setattr(near, "BLOCK", 3)
    rng, base = random.Random(3), [f"w{i}" for i in range(300)]
    rows = []
    for i in range(40):
        w = list(base)
        for k in rng.sample(range(300), 12 if i % 2 else 3):
            w[k] = f"x{i}-{k}"
        rows.append((i, " ".join(w)))
    sets = {i: shingle_set(t, 3) for i, t in rows}
    links = [(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    want = closed(links, sets)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(df, 3, 85).collect()}
    assert len(set(want.values())) > 1 and got == want


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = closed([x for x in links if x[0] != x[1]], {i for x in links for i in x})
    assert {r["node"]: r["component"] for r in got} == {i: c for i, c in want.items()
                                                       if any(i in x and x[0] != x[1] for x in links)}


def test_grace_spills():
    rng = random.Random(1)
    import hashlib
    records, want = [], defaultdict(lambda: [None, 0])
    for _ in range(3000):
        content = bytes([rng.randrange(4)]) * rng.randrange(1, 400)
        top = rng.choice([None, rng.randrange(100)])
        records.append((hashlib.sha256(content).digest(), content, top, 1))
        w = want[content]
        w[0], w[1] = max((x for x in (w[0], top) if x is not None), default=None), w[1] + 1
    for budget in (1, 2_000, 50_000, 10**9):
        got = list(grace.grace(iter(records), budget))
        assert len(got) == len(want) and all(want[e[1]] == [e[2], e[3]] for e in got)
    with pytest.raises(ValueError):
        list(grace.grace([(b"d" * 32, b"a", 1, 1), (b"d" * 32, b"b", 1, 1)]))


def test_passages_of_exact_runs(spark, small, texts):
    runs = defaultdict(set)
    for i, t in texts.items():
        w = words(t)
        for k in range(len(w) - 49):
            runs[tuple(w[k:k + 50])].add(i)
    shared = [v for v in runs.values() if len(v) > 1]
    got = {r["doc_id"]: r for r in passages.repeated_passages(small).collect()}
    assert shared and all(got[i]["n_dup_words"] >= 50 for v in shared for i in v)
    assert all(len({got[i]["class_id"] for i in v}) == 1 for v in shared)


def test_passages_edited(spark):
    rng = random.Random(8)
    fresh = lambda n: [f"v{rng.randrange(10**9)}" for _ in range(n)]
    passage, rows = fresh(90), []
    for i in range(12):
        w = list(passage)
        w[10 + 6 * i] = f"edit{i}"
        rows.append((i, " ".join(fresh(100 + i) + w + fresh(70))))
    rows += [(100 + i, " ".join(fresh(200))) for i in range(20)]
    got = {r["doc_id"]: r for r in passages.repeated_passages(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i]["class_id"] for i in range(12)} == {0}
    for i in range(12):
        (span,) = got[i]["spans"]
        assert abs(span["start"] - 100 - i) <= 12 and abs(span["end"] - 190 - i) <= 12
    assert all(got[i]["class_id"] == i and not got[i]["n_dup_words"] for i in range(100, 120))


def test_passages_of_one_key_in_other_contexts(spark):
    """Near-duplicates are found among texts that share their rarest shingles with texts that are none."""
    rng = random.Random(9)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    # A sentence long enough to have the smallest hashes of the passages around it, too short to be a passage.
    common, rows, pairs = fresh(36), [], []
    for i in range(12):
        rows.append((i, " ".join(fresh(60) + common + fresh(60))))
    for i in range(12, 24):
        before, after = fresh(7), fresh(7)
        rows += [(j, " ".join(fresh(60) + before + common + after + fresh(60))) for j in (i, i + 12)]
        pairs.append((i, i + 12))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {tuple(sorted((r["x_id"], r["y_id"]))) for r in passages.near_passages(docs).collect()}
    assert found == set(pairs)
    got = {r["doc_id"]: r for r in passages.repeated_passages(docs).collect()}
    assert all(got[i]["class_id"] == (i if i < 24 else i - 12) for i in range(36))


def test_window_classes_lose_no_context():
    """Every two contexts of a key meet in rows of two ids, every row of a class with several ids meets another id."""
    rng = np.random.RandomState(4)
    for size in (1, 2, 30, 400):
        rows = np.zeros(size, dtype=passages._WINDOW)
        for name, n in (("key", 5), ("context", 6), ("id", 4)):
            rows[name] = rng.randint(0, n, size)
        rows["ref"], rows["centre"] = np.arange(size), 7
        rows = passages._sorted(rows)
        classes = passages._Classes(rows)
        ids = defaultdict(set)
        for r in rows:
            ids[r["key"], r["context"]].add(r["id"])
        met = set()
        for a, b in zip(*classes.star()):
            assert all(rows[a][c] == rows[b][c] for c in ("key", "context")) and rows[a]["id"] != rows[b]["id"]
            met |= {a, b}
        assert all(i in met for i, r in enumerate(rows) if len(ids[r["key"], r["context"]]) > 1)
        joined = set()
        for a, b, sure in classes.across(rows["near"]):
            assert (rows["key"][a] == rows["key"][b]).all() and (rows["id"][a] != rows["id"][b]).all()
            for i, j, s in zip(a, b, sure):
                p, q = ((rows[x]["key"], rows[x]["context"]) for x in (i, j))
                assert p != q and s == (len(ids[p]) > 1 or len(ids[q]) > 1)
                joined |= {(p if len(ids[p]) > 1 else i, q if len(ids[q]) > 1 else j)}
        stands = lambda i: (lambda c: c if len(ids[c]) > 1 else i)((rows[i]["key"], rows[i]["context"]))
        for i in range(size):
            for j in range(i + 1, size):
                p, q = ((rows[x]["key"], rows[x]["context"]) for x in (i, j))
                if p[0] == q[0] and p != q and len(ids[p] | ids[q]) > 1:
                    assert (stands(i), stands(j)) in joined


def test_run_of_a_word_is_one_window():
    rng = random.Random(12)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    text = f"{fresh(60)} {'the ' * 400}{fresh(60)}".encode()
    windows = [w for *w, _ in passages._windows([text])]
    assert sum(len(w[0]) for w in windows) < 400
    for _, _, _, low, first, last, high in windows:
        assert ((low <= first) & (first <= last) & (last <= high)).all()
    assert sum(((low <= 100) & (high >= 400)).sum() for _, _, _, low, _, _, high in windows) == passages.HASHES


def test_windows_of_a_frequent_key_meet_by_what_they_share():
    """Of many windows around one sentence those that share a passage meet, the others do not."""
    rng = np.random.RandomState(6)
    rows = np.zeros(600, dtype=passages._WINDOW)
    rows["id"] = rows["ref"] = rows["context"] = np.arange(600)
    rows["near"] = rng.randint(0, 1 << 16, rows["near"].shape)
    middle = passages.SPAN
    rows["near"][:, middle - 15:middle + 15] = rng.randint(0, 1 << 16, 30)
    want = set()
    for k in range(0, 400, 2):
        # A passage of both: 30 shingles and, on either side or both, so many that 41 are shared.
        more = k // 2 % 12
        rows["near"][k + 1, middle - 15 - more:middle + 26 - more] = rows["near"][k, middle - 15 - more:middle + 26 - more]
        want.add((k, k + 1))
    # Words with a shingle twice are compared as sets, wherever they stand.
    rows["hash"][580:582] = passages._TWICE
    rows["near"][580, middle + 15:middle + 30] = rows["near"][581, middle + 16:middle + 31] = rng.randint(0, 1 << 16, 15)
    want.add((580, 581))
    classes = passages._Classes(passages._sorted(rows))
    met = {tuple(sorted(p)) for a, b, _ in classes.across(rows["near"]) for p in zip(a.tolist(), b.tolist())}
    assert met == want


def test_passages_of_repeated_shingles():
    """Where words repeat, exactly the passages that have a partner are found on either side."""
    rng = random.Random(1)
    for _ in range(60):
        sides = []
        for _ in "ab":
            words, length = [], rng.randint(60, 260)
            while len(words) < length:
                words += [rng.randint(1, 4) for _ in range(rng.randint(1, 8))] * rng.randint(1, 40)
            sides.append(hashing.ngrams(hashing.mix(np.array(words, dtype=np.uint64)), passages.N))
        sets = [[set(x[k:k + passages.SPAN].tolist()) for k in range(len(x) - passages.SPAN + 1)] for x in sides]
        near = [(i, j) for i, p in enumerate(sets[0]) for j, q in enumerate(sets[1]) if 100 * len(p & q) >= 80 * len(p | q)]
        i, j = passages.passages(*sides)
        assert set(i.tolist()) == {p for p, _ in near} and set(j.tolist()) == {q for _, q in near}


def test_passages_of_many_pairs_at_once():
    """Pairs that are verified together, or passage by passage, give what each gives by itself."""
    rng = random.Random(3)
    sides = []
    for _ in range(300):
        most = rng.choice([3, 20, 400, 10**9])
        fresh = lambda n: [rng.randrange(most) for _ in range(rng.randint(0, n))]  # noqa: E731,B023
        shared = fresh(200)
        other = list(shared)
        for _ in range(rng.randint(0, 3) if shared else 0):
            k = rng.randrange(len(other))
            other[k:k + rng.randint(0, 1)] = [10**10 + rng.randrange(10**6)] * rng.randint(0, 1)
            other = other or [1]
        texts = fresh(90) + shared + fresh(90), fresh(60) + other * rng.choice([1, 1, 1, 2]) + fresh(60)
        sides.append([hashing.ngrams(hashing.mix(np.array(t, dtype=np.uint64)), passages.N) for t in texts])
    a, b = zip(*sides)
    pair, i, j, left = passages._alike_many(np.concatenate(a), np.array([len(x) for x in a]),
                                            np.concatenate(b), np.array([len(x) for x in b]))
    assert 0 < len(left) < 150
    for k, (x, y) in enumerate(sides):
        want = [set(v.tolist()) for v in passages.passages(x, y)]
        got = passages._every(x, y) if k in left else (i[pair == k], j[pair == k])
        assert [set(v.tolist()) for v in got] == want


def test_a_common_passage_makes_few_pairs():
    """Windows of one passage in many contexts, some edited, meet some that stand for all; none is left out or cut off."""
    rng = np.random.RandomState(7)
    n, middle = 400, passages.SPAN
    near = rng.randint(0, 1 << 16, (n, 2 * passages.SPAN + 1)).astype(np.uint16)
    near[:, middle - 30:middle + 31] = rng.randint(0, 1 << 16, 61)
    for k in range(0, 150):
        at = rng.randint(middle - 30, middle - 5) if k % 2 else rng.randint(middle + 1, middle + 26)
        near[k, at:at + 5] = rng.randint(0, 1 << 16, 5)
    for k in range(150, 200):  # a family of its own, with one word that differs
        near[k, middle - 10:middle - 5] = near[150, middle - 10:middle - 5] + 1
        near[k, middle + 10:middle + 15] = rng.randint(0, 1 << 16, 5)
        near[k, 1:middle - 10] = near[150, 1:middle - 10]
    for k in range(200, 240):  # a run of one word
        near[k, middle - 40:middle + 41] = near[200, middle]
    rows = np.zeros(n, dtype=passages._WINDOW)
    rows["ref"] = rows["context"] = np.arange(n)
    rows["id"], rows["near"] = rng.permutation(n) // 2, near
    rows["hash"][200:240] = passages._TWICE
    rows = passages._sorted(rows)
    met = {(i, j) for a, b, _ in passages._Classes(rows).across(rows["near"]) for i, j in zip(a.tolist(), b.tolist())}
    assert len(met) < 12 * n and all(rows["id"][i] != rows["id"][j] for i, j in met)
    sets = [[set(x[k:k + passages.SPAN].tolist()) for k in range(1, passages.SPAN + 1)] for x in rows["near"]]

    def alike(i, j):
        return [k for k in range(passages.SPAN) if any(len(sets[i][k] & q) * 5 >= 4 * len(sets[i][k] | q)
                                                       for q in sets[j][max(k - 1, 0):k + 2])]

    some = [i for i in range(n) if rows["ref"][i] in {*range(0, 400, 8), *range(1, 400, 40)}]
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    partners = defaultdict(set)
    for i, j in met:
        partners[i].add(j)
        partners[j].add(i)
        root[find(i)] = find(j)
    for i in some:
        covered = {k for j in partners[i] for k in alike(i, j)}
        for j in some:
            if i != j and rows["id"][i] != rows["id"][j] and (k := alike(i, j)):
                assert covered >= set(k) and find(i) == find(j)


def test_compact_windows_cover_each_passage_once():
    rng = np.random.RandomState(2)
    x = rng.randint(0, 60, 400).astype(np.uint64)
    start, end = np.array([0, 150, 190]), np.array([150, 190, 400])
    text, left, centre, right = passages.compact_windows(x, start, end, 0)
    for t, (a, b) in enumerate(zip(start, end)):
        for i in range(a, b - passages.SPAN + 1):
            for j in (i + passages.SPAN - 1, min(i + passages.SPAN + 20, b - 1)):
                assert ((text == t) & (left <= i) & (i <= centre) & (centre <= j) & (j <= right)).sum() == 1
    assert (right - left + 1 >= passages.SPAN).all()


def test_substring_parts(spark, small, texts, monkeypatch):
    """Several suffix arrays per shard give what one gives."""
    monkeypatch.setattr(substrings, "ARRAY_BYTES", 5_000)
    key = lambda df: {r["doc_id"]: r["kept_sha256"] for r in df.collect()}
    first = {}
    for i in sorted(texts):
        t = texts[i].encode()
        for k in range(len(t) - 49):
            first.setdefault(t[k:k + 50], i)
    import hashlib
    want = {}
    for i, t in texts.items():
        t = t.encode()
        gone = np.zeros(len(t), dtype=bool)
        for k in range(len(t) - 49):
            if first[t[k:k + 50]] < i:
                gone[k:k + 50] = True
        want[i] = hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()
    assert key(substrings.repeated_spans(small)) == want


def test_strings_of_a_hot_anchor_are_spread(spark, monkeypatch):
    """A phrase with other neighbours in every text: its contexts go to all shards, with the rows of brute force."""
    import hashlib
    rng, phrase = random.Random(9), "the same phrase of some sixty bytes that stands in every text there is"
    fresh = lambda n: "".join(rng.choices("abcdefghijklmnop ", k=n))
    sides = [fresh(30) for _ in range(200)]
    texts = {i: fresh(60) + rng.choice(sides) + phrase + rng.choice(sides) + fresh(60) for i in range(400)}
    raw = {i: t.encode() for i, t in texts.items()}
    found = list(substrings._anchored(list(raw.values())))
    keys = np.concatenate([substrings.short(k) for _, _, _, k, _ in found])
    known, n = np.unique(keys, return_counts=True)
    table = pa.table({"id": pa.array(raw, pa.int64()), "th": pa.array(raw, pa.int64()), "text": pa.array(raw.values())})
    pack = lambda x: pa.array([x.astype("<u8").tobytes()], pa.binary())
    out = substrings._contexts(20)((pa.scalar(0),), table, pa.table({"keys": pack(known[n > 1]), "hot": pack(known[n > 100])}))
    per_shard = [len(x) // 2 for kind, x in zip(out["kind"].to_pylist(), out["b"].to_pylist()) if kind == 0]
    assert sum(n > 100) >= 3 and max(per_shard) < 1.5 * sum(per_shard) / 20

    first, want = {}, {}
    for i in sorted(raw):
        for k in range(len(raw[i]) - 49):
            first.setdefault(raw[i][k:k + 50], i)
    for i, t in raw.items():
        gone = np.zeros(len(t), dtype=bool)
        for k in range(len(t) - 49):
            if first[t[k:k + 50]] < i:
                gone[k:k + 50] = True
        want[i] = hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()
    monkeypatch.setattr(substrings, "HOT", 20)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["kept_sha256"] for r in substrings.repeated_spans(df).collect()} == want


def test_hot_anchors_are_those_of_many_contexts():
    """Copies of one passage are one context; a phrase with other neighbours in every text has one per text and edge."""
    rng = random.Random(4)
    fresh = lambda n: "".join(rng.choices("abcdefghijklmnop ", k=n)).encode()
    copied, framed = fresh(200), fresh(60)
    for passage, hot in ((lambda: copied, 0), (lambda: fresh(60) + framed + fresh(60), 1)):
        rows = []
        for block in range(4):
            ids = pa.array(range(50), pa.int64())
            table = pa.table({"id": ids, "th": ids, "text": pa.array([passage() for _ in ids], pa.binary())})
            rows.append(blocks._send(1, lambda t: substrings._per_text(substrings._anchored(t)), True)(
                (pa.scalar(block),), table))
        out = blocks._repeated(100)((pa.scalar(0),), pa.concat_tables(rows))
        assert out["block"].to_pylist() == [0, 1, 2, 3]
        found = [blocks.unpacked(out.slice(k, 1), "hot") for k in range(4)]
        assert len(found[0]) >= hot and all((x == found[0]).all() for x in found) and bool(len(found[0])) == bool(hot)


@given(st.dictionaries(st.integers(1, 60), st.integers(0, 40)), st.integers(60, 64))
@settings(max_examples=200, deadline=None)
def test_packing_plan(counts, capacity):
    held, fill, seen = defaultdict(list), {}, defaultdict(int)
    for length, rank, number, first, offset in packing.plan(counts, capacity):
        assert rank == seen[length]
        seen[length] += number
        for k in range(number):
            held[first + k].append((offset, length))
    assert {k: v for k, v in seen.items() if v} == {k: v for k, v in counts.items() if v}
    for items in held.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity and sum(3 * length > capacity for _, length in items) <= 2


def test_tokens_are_those_of_the_json_vocabulary():
    rng = random.Random(4)
    fast, slow = (packing.encoder(public_tokenizers.path(f"byte_bpe_50k.{x}")) for x in ("tiktoken", "json"))
    letters = " \t\n\r'’sdtrevlmABCabcéßñ0123456789.,;:!?*%$&()-_/\\\"<>|@#　 漢字🙂́\x0b\x85"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(60)))
        assert list(fast(text)) == list(slow(text))
    assert list(fast("<|endoftext|> x")) == list(slow("<|endoftext|> x"))


def test_tokens_are_those_of_an_unchanged_tokenizer():
    """Texts that hold an added token literally too."""
    from tokenizers import Tokenizer

    rng, plain = random.Random(5), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    fast, slow = (packing.encoder(public_tokenizers.path(f"byte_bpe_50k.{x}")) for x in ("tiktoken", "json"))
    parts = ["<|endoftext|>", "<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "\n\n", "a", "it's", "12", "é", "漢", "🙂", "|>", "<"]
    assert list(fast("a <|endoftext|> b")) == [64, 220, 50256, 275]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(20)))
        want = plain.encode(text, add_special_tokens=False).ids
        assert list(fast(text)) == want and list(slow(text)) == want


def test_packing_round_trip(spark, small, texts):
    rows = packing.pack(small, public_tokenizers.path("byte_bpe_50k.tiktoken"), 2).collect()
    encode = packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    by, bins, total = defaultdict(list), defaultdict(list), 0
    for r in rows:
        by[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in texts.items():
        ids, at = np.array(encode(t) + [2], dtype="<u4"), 0
        for r in sorted(by[i], key=lambda r: r["piece"]):
            assert r["start"] == at and zlib.crc32(ids[at:at + r["length"]].tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids) and (len(ids) > 1024 or len(by[i]) == 1)
        total += at
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= -(-total // 1024) + 2


def test_language_held_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = language.held_out()
    out = language.identify(docs, language.train(docs.where(~fold))).join(docs.where(fold).select("doc_id", "lang"), "doc_id")
    assert out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.97


def test_language_spans(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.train(docs)
    pick = {r["lang"]: r["text"] for r in docs.where("n_chars BETWEEN 600 AND 900").collect()}
    mixed = pick["en"][:400] + " " + pick["de"][:400]
    (row,) = language.identify(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).collect()
    assert [s["lang"] for s in row["spans"]] == ["en", "de"]
    assert abs(row["spans"][1]["start"] - len(pick["en"][:400].encode())) < 30


def test_scripts_narrow_candidates():
    model = language.Model(["ru", "xx"], np.zeros((language.CELLS, 2), np.float32),
                           np.array([[s == "Cyrillic", s != "Cyrillic"] for s in language.SCRIPTS]))
    ((score, start, end),) = language.word_scores(model, ["привет hello".encode()])
    assert (score.argmax(axis=1) == [0, 1]).all() and end.tolist() == [12, 18]


def test_viterbi_is_the_best_path():
    rng = np.random.RandomState(0)
    scores = [rng.randn(n, 3).astype(np.float32) for n in (0, 1, 5, 7, 3)]
    for s, labels in zip(scores, language.viterbi(scores, 0.7)):
        value = lambda p: sum(s[t, k] for t, k in enumerate(p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: E731,B023
        best = max(value(p) for p in np.ndindex(*(3,) * len(s)))
        assert abs(value(labels) - best) < 1e-4


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    fold = F.pmod(F.col("doc_id"), F.lit(3)) == 0
    out = quality.judge(docs, quality.grades_of(labels.where(~fold))).join(labels.where(fold), "doc_id")
    clean = (F.col("quality") == 1) & (F.col("toxic") == 0)
    row = out.agg(F.avg(F.when(clean, F.col("selected").cast("int"))).alias("kept"),
                  F.avg(F.when(F.col("toxic") == 1, (~F.col("selected")).cast("int"))).alias("caught")).first()
    assert row["kept"] >= 0.99 and row["caught"] >= 0.93


def test_quality_orders_grades():
    rng, rows, grades = np.random.RandomState(1), [], []
    for k in range(900):
        g = k % 3
        rows.append(np.unique(np.concatenate((rng.randint(0, 500, 30), [1000 + g] if rng.rand() < 0.95 else []))).astype(np.int64))
        grades.append(g)
    model = quality.fit(np.array(grades), rows, 3)
    assert (np.diff(model.thresholds) > 0).all()
    w = model.weights
    assert w[1000] < w[1001] < w[1002]


def test_quality_does_not_depend_on_partitions(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    grades = quality.grades_of(labels)
    count, n = grades.count(), 1 + grades.agg(F.max("grade")).first()[0]
    for most in (count // 3, count):
        a = quality.train(docs.repartition(1), grades.orderBy("doc_id").coalesce(1), n, most)
        b = quality.train(docs.repartition(7), grades.repartition(5, F.rand(3)), n, most)
        assert (a.weights == b.weights).all() and (a.thresholds == b.thresholds).all()


def test_lines_generalise_fields(spark):
    rng = random.Random(2)
    fresh = lambda n: " ".join(f"{chr(97 + rng.randrange(26))}{''.join(rng.choices('abcdefgh', k=7))}" for _ in range(n))
    rows = [(i, "\n".join([fresh(30), f"Posted on {i}-11-2019 by {fresh(1)} in the daily news section", fresh(30),
                           "All rights reserved by us", fresh(12)])) for i in range(9)]
    rows += [(100 + i, fresh(40) + "\nunique line of text number " + fresh(3)) for i in range(9)]
    copy = "\n".join(fresh(20) for _ in range(6))
    rows += [(200 + i, copy) for i in range(8)]
    out = {r["doc_id"]: r for r in lines.drop_recurring_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(9):
        assert out[i]["n_dropped"] == 2 and "rights" not in out[i]["text"] and "Posted" not in out[i]["text"]
        assert out[i]["text"].count("\n") == 2 and out[100 + i]["n_dropped"] == 0
    assert all(out[200 + i]["text"] == copy for i in range(8))


def test_short_and_blank_free_lines_recur(spark, tmp_path):
    """Lines of one or two tokens and of characters without blanks are lines like any other, in SQL too."""
    rng = random.Random(12)
    own = lambda: " ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(40))
    han = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(n))
    same = "本站所有内容均受版权保护未经许可不得转载"
    rows = [(i, f"{own()}\n{same}\n{han(60)}\nRead more\n\nShare") for i in range(8)]
    rows += [(100 + i, f"{own()}\n发布于{2000 + i}年{i + 1}月由本站编辑\n{han(40)}") for i in range(8)]
    rows += [(200 + i, f"{own()}\nRead mor{"ABCDEFGH"[i]}\n{han(5)}") for i in range(8)] + [(300, None), (301, "Share")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r for r in lines.drop_recurring_lines(docs).collect()}
    for i in range(8):
        text = dict(rows)[i].split("\n")
        assert out[i]["text"] == "\n".join((text[0], text[2], "")) and out[i]["n_dropped"] == 3
        text = dict(rows)[100 + i].split("\n")
        assert out[100 + i]["text"] == "\n".join((text[0], text[2]))
        assert out[200 + i]["n_dropped"] == 0

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    name = "op2_template_line_dedup"
    assert compare(spark, con, QUERIES[name], ORACLES[name], str(tmp_path)) == ""


def test_leaks_survive_edits(spark, small):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    rng, rows = random.Random(6), []
    items = [(r["item_id"], r["text"]) for r in bench.collect() if len(r["text"].split()) >= 20]
    for k, (item, text) in enumerate(items):
        w = text.split()
        for p in rng.sample(range(len(w)), len(w) // 10):
            w[p] = f"edited{p}"
        del w[len(w) // 2]
        rows.append((10_000 + k, f"before it {' '.join(w).upper()} and after", item))
    docs = small.select("doc_id", "text").union(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"))
    got = {r["doc_id"]: r["item_id"] for r in contamination.contaminated(docs, bench).collect()}
    assert all(got.get(d) == item for d, _, item in rows)
    exact = {r["doc_id"] for r in small.collect() if any(t in r["text"] for _, t in items)}
    assert exact <= got.keys()
    shuffled = [(1, " ".join(rng.sample(t.split(), len(t.split())))) for _, t in items]
    assert contamination.contaminated(spark.createDataFrame(shuffled, "doc_id long, text string"), bench).count() == 0


def test_leaks_of_few_kept_seeds(spark):
    """Copies that keep 20 to 45 % of an item's 3-grams, alone or beside an exact one, against alignment with whole texts."""
    rng, docs, items = random.Random(11), [], []
    for n in (45, 60, 75, 120, 200):
        for every, edit in ((3, "insert"), (4, "replace"), (5, "replace")):
            for beside in (False, True):
                k = len(items)
                w = [f"i{k}w{j}" for j in range(n)]
                c = list(w)
                for at in range(n - every, 0, -every):
                    c[at:at + (edit == "replace")] = [f"filler{rng.randrange(10**6)}"]
                grams = lambda x: {tuple(x[j:j + 3]) for j in range(len(x) - 2)}
                assert 0.2 <= len(grams(c) & grams(w)) / (n - 2) <= 0.45
                items.append((k, " ".join(w)))
                docs.append((len(docs), " ".join([f"own{rng.randrange(10**6)}" for _ in range(80)] + c + ["end"])))
                if beside:
                    docs.append((len(docs), f"before {' '.join(w)} after"))
        docs.append((len(docs), " ".join(w[:n // 4] + [f"other{j}" for j in range(60)] + w[3 * n // 4:])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    ready = contamination.prepare([(k, t.encode()) for k, t in items], df)
    want = {}
    for doc, h in zip((d for d, _ in docs), hashing.tokens([t.encode() for _, t in docs])):
        for item, word, weight in zip(ready.ids, ready.words, ready.weights):
            score = contamination.align(word, weight, h)[0] / weight.sum()
            if score >= contamination.LEAST:
                want[doc, item] = round(score, 9)
    got = {(r["doc_id"], r["item_id"]): round(r["score"], 9) for r in contamination.leaks(df, bench).collect()}
    assert len(want) >= 45 and got == want


def test_alignment():
    item, weight = np.arange(10, 20).astype(np.uint64), np.ones(10)
    assert contamination.align(item, weight, np.array([1, 2, *range(10, 20), 3], np.uint64)) == (10.0, 12)
    score, _ = contamination.align(item, weight, np.array([10, 11, 12, 99, 14, 15, 17, 18, 19], np.uint64))
    assert score == 8 - 0.5 - 0.5


def test_archives_of_other_writers(spark, tmp_path):
    """Whole-file streams, several members and an archive that breaks off."""
    import gzip
    record = lambda k: warc.response(f"<urn:gleaner:page:{k}>", f"http://x/{k}", f"page {k}".encode() * 50)
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "1.warc.gz").write_bytes(gzip.compress(record(1) + record(2)))
    (raw / "2.warc.gz").write_bytes(gzip.compress(record(3)) + gzip.compress(record(4) + record(5)))
    (raw / "3.warc.gz").write_bytes(gzip.compress(record(6) + record(7)[:200]))
    plan = spark.createDataFrame([(1, 0, False, None), (1, 1, True, 1), (2, 0, False, None), (3, 0, False, None)],
                                 "archive long, record long, revisit boolean, first_id long")
    index = warc.normalise(str(raw), str(tmp_path / "out"), plan)
    errors = [(r["archive"], r["record"]) for r in index.where("error IS NOT NULL").collect()]
    assert errors == [(3, 1)]
    rows = {r["page_id"]: r for r in warc.read_records(index, str(tmp_path / "out")).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6] and rows[2]["refers_to"] == 1 and rows[2]["payload_bytes"] == 300
    whole = gzip.decompress((tmp_path / "out" / "2.warc.gz").read_bytes())
    assert [h["WARC-Record-ID"] for h, _ in warc.parse(iter([whole]))] == [f"<urn:gleaner:page:{k}>" for k in (3, 4, 5)]
    sidecar = (tmp_path / "out" / "2.idx.jsonl").read_text().splitlines()
    assert len(sidecar) == 3


def test_pipeline(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    bench = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    steps = {}
    rows = docs
    for name, step in corpus_pipeline.STAGES:
        rows = corpus_pipeline.stage(step(spark, rows, sf_dir), f"test-{name}")
        if name != "packing":
            assert rows.columns == docs.columns
            steps[name] = {r["doc_id"]: r["text"] for r in rows.collect()}
    toxic = {r["doc_id"] for r in labels.where("toxic = 1").collect()}
    good = {r["doc_id"] for r in labels.where("toxic = 0 AND quality = 1").collect()}
    assert len(toxic - steps["quality"].keys()) >= 0.7 * len(toxic)
    assert len(good & steps["quality"].keys()) >= 0.98 * len(good)
    assert steps["quality"].keys() == steps["line_dedup"].keys()
    sets = {i: shingle_set(t, 5) for i, t in steps["line_dedup"].items()}
    places = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            places[g].add(i)
    near_to = {i: {j for g in s for j in places[g] if j < i} for i, s in sets.items()}
    links = [(i, j) for i, others in near_to.items() for j in others
             if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    want = {i for i, top in closed(links, sets).items() if i == top}
    assert links and steps["near_dedup"].keys() == want
    leaked = {i for i, t in steps["near_dedup"].items() if any(b in t for b in bench)}
    assert leaked and not leaked & steps["decontamination"].keys()
    assert len(steps["near_dedup"].keys() - leaked - steps["decontamination"].keys()) <= 2
    assert {r["doc_id"] for r in rows.collect()} == steps["decontamination"].keys()
    assert corpus_pipeline.run(spark, sf_dir).count() == rows.count()
