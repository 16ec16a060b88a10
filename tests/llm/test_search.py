"""Prefix trie, lexical search and decontamination against brute force, and their awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from strandloom.llm import decontamination, lexical, terms, trie
from strandloom.llm import queries as q

TALK = "conv_id long, turn long, role string, text string, d long, fp string, c string"
LOWER = str.maketrans(terms.UPPER, terms.LOWER)


def words(text):
    return re.findall(terms.WORD, (text or "").translate(LOWER))


def test_pieces_are_the_words_of_the_pattern(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abAZ09 .,é漢\n@[`{\x7f\x00") for _ in range(rng.choice([0, 5, 50, 3000]))) for _ in range(100)] + ["x" * 5000 + " y Z", "ab C " * 2000]
    for size in (64, 1 << 19):
        monkeypatch.setattr(terms, "PIECE", size)
        raw, got, seen = [t.encode() for t in texts], defaultdict(list), {}
        for which, start, end, h in terms.pieces(raw):
            for i, s, e, x in zip(which.tolist(), start.tolist(), end.tolist(), h.tolist(), strict=True):
                word = raw[i][s:e].decode()
                got[i].append(word)
                assert seen.setdefault(word.translate(LOWER), x) == x
        assert [got[i] for i in range(len(texts))] == [re.findall(terms.WORD_ANY_CASE, t) for t in texts]
        assert len(set(seen.values())) == len(seen)


# Prefix trie


def brute_trie(talks):
    """Nodes by (depth, conv_id) from plain lists of rows."""
    key = lambda r: (r[1] is not None, r[1] or 0, hashlib.sha256(f"{len((r[2] or '').encode())}:{r[2] or ''}{r[3] or ''}".encode()).digest())
    by = defaultdict(list)
    for r in talks:
        if r[0] is not None:
            by[r[0]].append(r)
    own = {c: [(r[2] or "", r[3] or "") for r in sorted(rows, key=key)] for c, rows in by.items()}
    made = {}
    for c, rows in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = own.get(c - c % 5, [])[:h] + rows[h:]
    nodes = defaultdict(list)
    for c, rows in made.items():
        for d in range(len(rows) + 1):
            nodes[tuple(rows[:d])].append(c)
    children = defaultdict(list)
    for n in nodes:
        if n:
            children[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(nodes, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in children[n]) if children[n] else 1
        saved[n] = sum(saved[k] for k in children[n]) + ((len(nodes[n]) - 1) * len(n[-1][1].encode()) if n else 0)
    ends = lambda n: hashlib.sha256(",".join(str(c) for c in sorted(nodes[n]) if len(made[c]) == len(n)).encode()).hexdigest()
    return sorted((min(m), len(n), min(nodes[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saved[n], ends(n)) for n, m in nodes.items())


def talks_of(rng, n):
    rows = []
    for c in rng.sample(range(-3, 4 * n), n):
        for t in range(rng.choice([1, 1, 2, 4, 9, 12])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é", "", None]), 1, "x", "y"))
    return rows


@pytest.mark.parametrize(("piece", "bits", "seed"), [(1 << 16, 64, 1), (3, 64, 2), (1 << 16, 2, 3), (3, 3, 4)])
def test_trie_equals_brute_force(spark, piece, bits, seed):
    """Short pieces carry sums over; few bits make fingerprints collide at every depth."""
    rows = talks_of(random.Random(seed), 40)
    rows += [(None, 1, "user", "lost", 1, "x", "y"), rows[0]]
    paths = trie.rebuilt(trie.turns(spark.createDataFrame(rows, TALK)))
    got = sorted(tuple(r) for r in trie.prefix_trie(paths, piece, bits).collect())
    assert [(r[1], *r) for r in got] == [(r[1], *r) for r in sorted(brute_trie(rows))]


def test_trie_of_a_long_and_a_common_conversation(spark):
    rows = [(1, t, "user", f"t{t % 7}", 1, "", "") for t in range(300)] + [(10 * c, 0, "user", "hi", 1, "", "") for c in range(2, 200)]
    got = sorted(tuple(r) for r in trie.prefix_trie(trie.rebuilt(trie.turns(spark.createDataFrame(rows, TALK))), piece=16).collect())
    assert got == brute_trie(rows)


def test_trie_without_rebuilding_and_without_rows(spark):
    rows = [(c, t, "user", x, 1, "", "") for c, talk in ((1, "ab"), (2, "ac"), (3, "ab")) for t, x in enumerate(talk)]
    got = sorted((r.depth, r.conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) for r in trie.prefix_trie(trie.plain_paths(trie.turns(spark.createDataFrame(rows, TALK)))).collect())
    assert got == [(0, 1, 3, 1, 2, 3), (1, 1, 3, 2, 2, 3), (2, 1, 2, 0, 1, 1), (2, 2, 1, 0, 1, 0)]
    assert trie.prefix_trie(trie.rebuilt(trie.turns(spark.createDataFrame([], TALK)))).count() == 0


# Lexical search


def brute_search(docs, items, k=10):
    tf = [(d, Counter(words(t))) for d, t in docs]
    n = [sum(c.values()) for _, c in tf]
    n_docs, total = sum(x > 0 for x in n), sum(n)
    df = Counter(w for _, c in tf for w in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(words(t))
    out = []
    for i, ts in asked.items():
        scores = []
        for row, (d, c) in enumerate(tf):
            m = 10 + (90 * n[row] * n_docs) // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w in ts if c[w])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(i, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def corpus(rng, n):
    vocabulary = [f"w{k}" for k in range(60)] + ["É", "ß1"]
    text = lambda: " ".join(vocabulary[min(int(rng.expovariate(0.12)), 61)].upper() if rng.random() < 0.2 else vocabulary[min(int(rng.expovariate(0.12)), 61)] for _ in range(rng.choice([0, 1, 8, 40])))
    return [(i, text()) for i in range(n)]


@pytest.mark.parametrize("block_pairs", [20, lexical.BLOCK_PAIRS])
def test_search_equals_brute_force(spark, monkeypatch, block_pairs):
    monkeypatch.setattr(lexical, "LEAST", 3)  # so that few postings are in the first tier
    rng = random.Random(5)
    docs = corpus(rng, 400)
    items = [(i, t) for i, t in corpus(rng, 25) if t] + [(100, docs[7][1] + " " + docs[8][1]), (101, None), (102, "unheardof"), (103, "w59 w58"), (103, "w40")]
    docs += [(None, "w59 w59"), (None, None), (5, docs[5][1]), (6, "w58 " * 3000)]
    told = []
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_pairs=block_pairs, told=told)
    assert sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=str) == brute_search(docs, items)
    assert block_pairs == 20 or told[0] == len({i for i, t in items if t}) > told[-1]  # some are proven early, some go on


def test_search_proves_a_distinct_item_in_the_first_tier(spark):
    docs = [(i, f"common{i % 7} word " + ("rare1 rare2 rare3 " * (1 + i % 3) if i < 40 else "")) for i in range(3000)]
    told = []
    items = spark.createDataFrame([("x", "rare1 rare2 rare3 word")], "item_id string, text string")
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"), items, told=told)
    assert told == [1]
    assert [tuple(r) for r in got.orderBy("rank").select("item_id", "rank", "doc_id", "score").collect()] == sorted(brute_search(docs, [("x", "rare1 rare2 rare3 word")]), key=lambda r: r[1])


def test_most_items_need_no_last_tier(spark):
    """Frequent words weigh little: what the lower tiers may add can't lift an unseen document to the k-th best."""
    rng = random.Random(11)
    common, rare = [f"c{k}" for k in range(30)], [f"r{k}" for k in range(3000)]
    docs = [(i, " ".join(rng.choices(common, k=60) + rng.choices(rare, k=12))) for i in range(4000)]
    items = [(i, " ".join(rng.choices(common, k=12) + rng.choices(rare, k=12))) for i in range(20)]
    told = []
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), told=told)
    assert sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=str) == brute_search(docs, items)
    assert told[0] == 20 and (len(told) < 3 or told[2] <= 5)


def test_search_of_awkward_rows(spark, awkward, empty):
    items = spark.createDataFrame([(1, "one two seven", "x"), (None, "short", "x"), (2, None, None), (3, "", None)], "item_id long, text string, doc_id string")
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = lexical.search(awkward, items).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_search(rows, [(r.item_id, r.text) for r in items.collect()])
    assert lexical.search(empty, items).columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical.search(empty, items).count() == 0 and lexical.search(awkward, items.limit(0)).count() == 0


# Decontamination


def brute_hits(text, items, window):
    ws, its, hit = words(text), set(), set()
    for i, t in items:
        iw = words(t)
        k = min(window, len(iw))
        grams = {tuple(iw[a : a + k]) for a in range(len(iw) - k + 1)} if iw and i is not None else set()
        for a in range(len(ws) - k + 1):
            if tuple(ws[a : a + k]) in grams:
                its.add(str(i))
                hit |= set(range(a, a + k))
    return len(ws), len(hit), sorted(its)


def test_automaton_equals_brute_force(monkeypatch):
    rng = random.Random(2)
    for trial in range(120):
        monkeypatch.setattr(terms, "PIECE", 16 if trial % 3 == 0 else 1 << 19)
        window, letters = rng.choice([2, 3, 4, 5]), ["a", "b", "C", "é", "x1"][: rng.choice([2, 3, 5])]
        make = lambda n: " ".join(rng.choice(letters) for _ in range(n))  # noqa: B023, E731
        items = [(i, make(rng.choice([0, 1, 2, 3, 4, 6, 9, 14]))) for i in range(rng.choice([1, 2, 5, 8]))]
        texts = [make(rng.choice([0, 1, 5, 20, 60])) for _ in range(10)]
        auto = decontamination.Automaton([(str(i), words(t)) for i, t in items], window).prepared()
        n, walks = decontamination._scan([t.encode() for t in texts], auto)
        for k, t in enumerate(texts):
            spans = walks[k].spans if k in walks else []
            assert (n[k], sum(s[3] for s in spans), sorted(auto.ids[i] for i in walks[k].items) if k in walks else []) == brute_hits(t, items, window)
            assert all(a[2] + a[3] < b[2] for a, b in zip(spans, spans[1:], strict=False))
            for s in decontamination._chars(t.encode(), spans):
                assert len(words(t[s[0] : s[1]])) == s[3] and s[4] >= min(s[3], auto.shortest)


@pytest.mark.parametrize("block_words", [12, decontamination.BLOCK_WORDS])
def test_matches_in_blocks_equal_brute_force(spark, awkward, block_words):
    rng = random.Random(9)
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    items = [(1, "One, two; THREE four five"), (2, "seven"), (3, None), (4, ""), (None, "short"), (5, "consectetur Lorem ipsum dolor"), (6, "card 4111 1111 1111 1111 end"), (7, " ".join(rng.choice("abcd") for _ in range(30))), (2, "four five six seven")]
    rows = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.matches(awkward, rows, window=4, block_words=block_words).collect()
    want = sorted(((d, *brute_hits(t, items, 4)) for d, t in docs), key=str)
    assert sorted(((r.row.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got), key=str) == want
    assert all(sum(s.n_words for s in r.spans) == r.n_hit for r in got)


def test_decontaminated_texts(spark, empty):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    docs = [(1, f"Ünder the sun: {passage.upper()}! And on it goes for a good many further words, so it stays mostly itself."), (2, passage), (3, "clean"), (4, None), (5, passage[:40])]
    items = spark.createDataFrame([(1, f"what is {passage}"), (2, "?")], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.row.doc_id: r for r in decontamination.decontaminate(df, items).collect()}
    assert got[1].clean_text == docs[0][1].replace(passage.upper(), "") and not got[1].dropped
    assert [s.longest for s in got[1].spans] == [11]
    assert got[2].dropped and got[2].clean_text == ""
    assert (got[3].clean_text, got[4].clean_text, got[5].clean_text) == ("clean", None, passage[:40])
    assert not any(got[k].dropped for k in (3, 4, 5))
    assert decontamination.matches(empty, items).count() == 0
    assert {r.n_hit for r in decontamination.matches(df, items.limit(0)).collect()} == {0}


def test_queries_are_registered():
    assert {"op11_prefix_trie", "op12_lexical_search", "op13_decontaminate"} <= q.queries().keys() & q.oracle_sql().keys()


def test_documents_are_read_without_a_shuffle(spark, sf_dir):
    plan = q.op13_decontaminate(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
