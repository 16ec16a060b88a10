"""Near-duplicates, substrings, quality, personal data, mixing and tokens against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom.llm import bpe, mixing, neardup, pii, quality, shingles, substrings
from strandloom.llm import queries as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows, percent):
    """doc_id -> smallest reachable id, by comparing all pairs."""
    sets = {i: shingle_set(t) for i, t in rows}
    ids = sorted(sets)
    label = {i: i for i in ids}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                p, r = root(a), root(b)
                label[max(p, r)] = min(p, r)
    return {i: root(i) for i in ids}


def made_up(n, seed):
    """Documents, near copies of documents, and near copies of those."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    out = []
    for i in range(n):
        if out and rng.random() < 0.6:
            w = rng.choice(out)[1].split()
            for _ in range(rng.choice([0, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(words)
        else:
            w = rng.choices(words, k=rng.choice([1, 3, 5, 8, 40, 120]))
        out.append((i, " ".join(w)))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("percent", "seed"), [(85, 1), (80, 2)])
def test_near_duplicates_equal_brute_force(spark, percent, seed):
    rows = made_up(260, seed)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows, percent)
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(shingle_set(t)) for i, t in rows}
    assert all(r.kept == (r.component_id == r.doc_id) for r in got)


def test_near_duplicates_of_large_groups(spark, monkeypatch):
    """Tiles and buckets far smaller than the group give the same components."""
    monkeypatch.setattr(neardup, "TILE_SETS", 16)
    monkeypatch.setattr(neardup, "BUCKET_TILE", 16)
    rng = random.Random(4)
    base = [f"b{k}" for k in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 6])):
            w[rng.randrange(60)] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows, 85)


def test_chains_are_settled_by_pairs(spark, monkeypatch):
    """A long chain of small changes, and copies of one text: few full sets are left for the tiles."""
    sent = []
    tiled = neardup.tiled
    monkeypatch.setattr(neardup, "tiled", lambda groups, *rest: sent.append(groups.count()) or tiled(groups, *rest))
    rng = random.Random(7)
    w = [f"c{k}" for k in range(120)]
    rows = []
    for i in range(250):
        w = list(w)
        w[rng.randrange(120)] = f"n{i}"
        rows.append((i, " ".join(w)))
    base = [f"d{k}" for k in range(120)]
    for i in range(250):
        copy = list(base)
        copy[rng.randrange(120)] = f"m{i}"
        rows.append((1000 + i, " ".join(copy)))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows, 85)
    assert sum(sent) <= 50  # none where nothing is open


def registers_of(spark, labels):
    """Classes whose registers differ in a few places, and members of one bucket with these labels."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 16, neardup.REGISTERS).astype(np.uint16)
    rows, members = [], []
    for i, label in enumerate(labels):
        own = base.copy()
        own[rng.integers(0, neardup.REGISTERS, 12)] ^= np.uint16(1)
        rows.append((i, 100, own.tobytes()))
        members.append((1, i, 100, label))
    return spark.createDataFrame(members, "key long, rep long, n long, label long"), spark.createDataFrame(rows, "rep long, n long, registers binary")


def test_crossings_are_a_forest(spark):
    """Many labels that are all alike: fewer pairs than labels, which connect them all."""
    members, classes = registers_of(spark, range(120))
    got = neardup.crossings(members, classes, 0.7, 85, every=False).collect()
    assert len(got) == 119 and {x for r in got for x in (r.la, r.lb)} == set(range(120))
    root = list(range(120))
    for r in got:
        assert (r.a, r.b) == (r.la, r.lb)
        root[max(neardup.find(root, r.a), neardup.find(root, r.b))] = min(neardup.find(root, r.a), neardup.find(root, r.b))
    assert {neardup.find(root, k) for k in range(120)} == {0}
    flagged = [r for r in neardup.crossings(members, classes, 0.7, 85, every=True).collect() if r.a == r.b]
    assert len(flagged) == 120


def test_the_largest_label_is_not_crossed_with_itself(spark, monkeypatch):
    """A large group that a few others meet: its rows grow with it, not with its square."""
    monkeypatch.setattr(neardup, "BUCKET_TILE", 8)
    members, classes = registers_of(spark, [7] * 200 + [9, 9, 11])
    sent = neardup.in_tiles(members).groupBy("i", "j").count().collect()
    assert sum(r["count"] for r in sent) <= 200 + 3 * 27 and all(r.i == 0 for r in sent)
    got = neardup.crossings(members, classes, 0.7, 85, every=True).collect()
    assert {x for r in got if r.a != r.b for x in (r.la, r.lb)} == {7, 9, 11}
    assert {r.a for r in got if r.a == r.b} == set(range(203))


def test_ids_with_several_texts_are_one_document(spark):
    a, b, c = ("the first text of seven words here", "another text with other words in it", "and a third one that nobody has")
    rows = [(1, a), (3, b), (5, a), (5, b), (7, c), (8, c + " at"), (7, "unlike")]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (3, 1), (5, 1), (5, 1), (7, 7), (7, 7), (8, 8)]


def test_near_duplicates_of_awkward_rows(awkward, empty):
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in neardup.near_duplicates(awkward).collect()}
    assert got[(1, 3)] == (1, True) and got[(2, 3)] == (1, False)
    assert got[(3, 0)] == (3, True) and got[(4, 0)] == (4, True) and got[(5, 0)] == (5, True)
    assert got[(None, 3)] == (None, True)
    assert got[(8, 1)] == (8, True) and got[(9, 1)] == (8, False)
    assert neardup.near_duplicates(awkward).count() == awkward.count()
    assert neardup.near_duplicates(empty).count() == 0


def test_shingles_do_not_depend_on_batches():
    rng = random.Random(9)
    texts = [" ".join(rng.choices(["ab", "C", "dé", "x" * 50, ""], k=rng.randrange(30))) + rng.choice(["", "\n", "\x0b"]) for _ in range(60)] + [None, "", "\u00a0 nbsp is a word"]
    alone = [shingles.sets_of([t])[0] for t in texts]
    for size in (64, 1 << 20):
        for a, b in zip(alone, shingles.sets_of(texts, size), strict=True):
            assert (a == b).all()
    assert [len(s) for s in alone] == [len(shingle_set(t)) for t in texts]


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(f"word{k % 977}" for k in range(5000))
    whole = shingles.sets_of([text])[0]
    monkeypatch.setattr(shingles, "PIECE", 100)
    assert (shingles.sets_of([text])[0] == whole).all()


def test_a_pair_at_any_threshold_shares_a_band():
    for percent in (50, 70, 80, 85, 90, 99):
        n, rows = neardup.banding(percent)
        assert n * rows <= neardup.REGISTERS and (1 - (percent / 100) ** rows) ** n < 1e-6
    assert neardup.banding(85) == (36, 7) and neardup.banding(100)[0] == 1
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 16, (20_000, neardup.REGISTERS)).astype(np.uint16)
    b = np.where(rng.random(a.shape) < 0.8, a, a ^ np.uint16(1))
    n, rows = neardup.banding(80)
    assert (neardup.band_keys(a, n, rows) == neardup.band_keys(b, n, rows)).any(axis=1).all()


def test_estimates_are_close():
    rng = np.random.default_rng(0)
    for size in (30, 300, 3000):
        for share in (0.5, 0.85):
            common = int(2 * size * share / (1 + share))
            h = np.unique(shingles.mix(rng.integers(0, 1 << 62, 2 * size, dtype=np.uint64)))
            a, b = np.sort(h[:size]), np.sort(np.concatenate([h[size - common : size], h[size : 2 * size - common]]))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            est = neardup.estimate(neardup.signature(a)[None], neardup.signature(b)[None], np.array([len(a)]), np.array([len(b)]))[0]
            assert abs(est - true) < 0.16


def own_units(text, least):
    """(start, end, words) of a text's lines and runs of sentences, found another way: a character at a time."""
    pieces, at = [], 0  # start, end, words, whether a line ends here
    for k, c in enumerate(text):
        ends = c == "\n" or (c in ".!?" and (k + 1 == len(text) or text[k + 1] not in ".!?")) or k + 1 == len(text)
        if ends:
            pieces.append((at, k + 1, c == "\n" or k + 1 == len(text)))
            at = k + 1
    said, lines, line = [], [], []
    for s, e, last in pieces:
        words = tuple("".join(x if x.isalnum() or x == "_" else " " for x in text[s:e].lower()).split())
        if words:
            body = text[s:e]
            said.append((s + len(body) - len(body.lstrip()), s + len(body.rstrip()), words))
            line.append(said[-1])
        if last:
            lines += [line] if line else []
            line = []
    out = {(u[0][0], u[-1][1], sum((p[2] for p in u), ())) for u in lines}
    for k in range(len(said)):
        held = ()
        for s, e, words in said[k:]:
            held += words
            if len(held) >= least:
                out.add((said[k][0], e, held))
                break
    return out


def brute_repeats(rows, least):
    """Removed units by loops. Chosen runs are taken from the operator, but compared by their own words."""
    units = []
    for i, t in rows:
        if i is not None:
            starts, ends, _ = substrings.runs(t or "", least)
            chosen = {(int(s), int(e), tuple(re.findall(r"\w+", t[s:e].lower()))) for s, e in zip(starts, ends, strict=True)}
            # A unit has one place a kind: runs that are chosen by their hashes only match their like.
            units += [(i, s, e, ("own", w)) for s, e, w in own_units(t or "", least)] + [(i, s, e, ("run", w)) for s, e, w in chosen]
    units.sort(key=lambda u: u[:2])
    first: dict = {}
    for u in units:
        first.setdefault(u[3], u)
    could = {u for u in units if u[:2] != first[u[3]][:2] and (first[u[3]][0] != u[0] or u[1] >= first[u[3]][2])}
    touched = {k for k, f in first.items() if any(u[0] == f[0] and u[1] < f[2] and f[1] < u[2] for u in could)}
    return {(i, s, e, *first[k][:2]) for i, s, e, k in could if k not in touched}


@pytest.mark.parametrize(("seed", "sample"), [(2, 100), (3, 2000)])
def test_substrings_equal_brute_force(spark, monkeypatch, seed, sample):
    monkeypatch.setattr(substrings, "SAMPLE_DOCS", sample)  # with few, units that occur three times are common
    rng = random.Random(seed)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.randrange(1, 9))).capitalize() + rng.choice([".", "!", "?\n", "\n"]) for _ in range(40)]
    rows = [(i, " ".join(rng.choices(pool, k=rng.randrange(0, 12)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substrings.repeated_units(docs, min_words=4).collect()
    assert {(r.doc_id, r.start, r.end, r.kept_doc_id, r.kept_start) for r in got} == brute_repeats(rows, 4)
    left = {r.doc_id: r.text for r in substrings.without(docs, substrings.repeated_units(docs, min_words=4)).collect()}
    text = dict(rows)
    for r in got:  # the kept occurrence is still there whole
        assert text[r.kept_doc_id][r.kept_start : r.kept_end] in left[r.kept_doc_id]


def test_what_is_removed_is_kept_elsewhere(spark):
    """A = b c, B = a b c, C = a b: with b c gone from B, the a b of C is the last one and stays."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(15)).capitalize() + "." for x in "abc")
    rows = [(1, f"{b} {c}"), (2, f"{a} {b} {c}"), (3, f"{a} {b}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.text for r in substrings.without(docs, substrings.repeated_units(docs)).collect()}
    said = " ".join(left[k] for k in (1, 2, 3))
    assert a in said and b in said and c in said and left[1] == rows[0][1]


def test_short_documents_and_lines_are_units(spark):
    thirteen = "one two three four five six seven eight nine ten eleven twelve thirteen"
    rows = [(1, thirteen), (2, thirteen.upper()), (3, "Menu\nnow something else"), (4, "another text\nmenu\n"), (5, "Yes"), (6, "yes!")]
    got = substrings.repeated_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.kept_doc_id) for r in got} == {(2, 1), (4, 3), (6, 5)}


def test_a_passage_in_the_middle_of_a_sentence_is_found(spark):
    passage = "Start of it and then some words. " + "Here are more than fourteen words so that the unit is long enough to count. The end of it comes here."
    rows = [(1, f"Alpha beta gamma, {passage} Tail one."), (2, f"Other words before\nthat {passage} Tail two."), (3, "Nothing of it here at all, though it is a long text with many more words than fourteen.")]
    got = substrings.repeated_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == {2} and {r.kept_doc_id for r in got} == {1}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.text for r in substrings.without(docs, substrings.repeated_units(docs)).collect()}
    assert left[1] == rows[0][1] and left[3] == rows[2][1] and "more than fourteen" not in left[2] and left[2].startswith("Other words before")


def test_a_short_line_is_found_whatever_follows_it(spark):
    rows = [(k, f"Text number {k} begins with {w}\nShare this page with friends\nThen {w} goes on alone") for k, w in enumerate(("oaks", "rivers", "stones"))] + [(7, "Short whole text"), (8, "short, whole text!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = substrings.repeated_units(docs)
    left = {r.doc_id: r.text for r in substrings.without(docs, spans).collect()}
    assert [("Share" in left[k]) for k in range(3)] == [True, False, False] and all(w in left[k] for k, w in enumerate(("oaks", "rivers", "stones")))
    assert left[7] == "Short whole text" and left[8] == ""
    assert list(substrings.units(None)) == []


def test_a_passage_inside_long_sentences_is_found(spark):
    rng = random.Random(5)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(n))
    passage = words(60)
    rows = [(1, f"{words(20)} {passage} {words(20)}."), (2, f"{words(9)} {passage.upper()}, {words(30)}"), (3, words(80))]
    got = substrings.repeated_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.kept_doc_id) for r in got} == {(2, 1)}
    at = rows[1][1].index(passage.upper())
    reached = {k for r in got for k in range(r.start, r.end)}
    assert all(at <= r.start and r.end <= at + len(passage) for r in got)
    assert len(reached) >= 6 * (60 - 2 * (substrings.SPREAD - 1)) - 1


def test_substrings_of_awkward_rows(awkward, empty):
    got = substrings.repeated_units(awkward, min_words=5).collect()
    assert {(r.doc_id, r.kept_doc_id) for r in got if r.doc_id < 6} == {(2, 1)}
    assert substrings.repeated_units(empty).count() == 0
    assert substrings.without(awkward, substrings.repeated_units(awkward, min_words=5)).count() == awkward.count()


def test_quality_separates_held_out_documents(spark):
    from pyspark.sql.functions import col

    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = quality.fit(docs, labels.filter("doc_id % 2 = 0"))
    out = quality.classify(docs, model).join(labels.filter("doc_id % 2 = 1"), "doc_id").select(col("kept"), col("quality")).collect()
    good, bad = [r.kept for r in out if r.quality == 1], [not r.kept for r in out if r.quality == 0]
    assert sum(good) / len(good) > 0.995 and sum(bad) / len(bad) > 0.95


def test_document_evidence_equals_brute_force():
    rng = random.Random(6)
    pool = ["The", "cat", "sat", "ON", "mat1", "cat", "$$$", "a|b", "é"]
    texts = [" ".join(rng.choices(pool, k=rng.randrange(0, 9))) + rng.choice(["", "\n", " x"]) for _ in range(30)] + [None, "", "zz yy zz"]
    good = np.array([rng.randrange(2) for _ in texts])

    def grams(t):
        w, raw = WORD.findall((t or "").translate(LOWER)), (t or "").encode()
        return [w, list(zip(w, w[1:], strict=False)), [raw[k : k + 3] for k in range(len(raw) - 2)]]

    n_fit, ratios = 20, []
    for k, width in enumerate(quality.BUCKETS):
        held: dict = {}
        total = [0.0, 0.0]
        for t, y in list(zip(texts, good, strict=True))[:n_fit]:
            own = grams(t)[k]
            total[y] += bool(own)
            for g in own:
                held.setdefault(g, [0.0, 0.0])[y] += 1 / len(own)
        share = lambda x, y: np.log((x + quality.PRIOR) / (total[y] + quality.PRIOR * width))  # noqa: E731, B023
        ratios.append({g: share(v[1], 1) - share(v[0], 0) - share(0, 1) + share(0, 0) for g, v in held.items()})
    tables = quality.log_ratios(quality.bucket_weights(texts[:n_fit], good[:n_fit]))
    got = quality.features(texts, tables)
    for t, x in zip(texts, got, strict=True):
        own = grams(t)
        want = [sum(r.get(g, 0) for g in o) / (len(o) + quality.FEW) for o, r in zip(own, ratios, strict=True)]
        want += [sum(g not in r for g in o) / (len(o) + quality.FEW) for o, r in zip(own, ratios, strict=True)]
        raw, w = (t or "").encode(), max(len(own[0]), 1)
        n = max(len(raw), 1)
        have = lambda chars: sum(c in chars for c in raw)  # noqa: E731, B023
        echo = sum(a == b for a, b in own[1])
        want += [have(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") / n, have(b"!$%&#*@^~") / w, have(b"|<>{}[]\\") / w, echo / w, have(b"0123456789") / n, min(n / w / 20, 1), np.log1p(len(own[0])) / 12]
        assert np.allclose(x, want, atol=1e-5), t


def test_posteriors_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["h1", "h2", "h3", None]), rng.choice(["p", "q", None]), rng.random()) for i in range(300)]
    scored = spark.createDataFrame(rows, "doc_id long, host string, path string, p double")
    got = {r.doc_id: r for r in quality.judge(scored, quality.posteriors(scored)).collect()}

    def strength(cells, means):
        m = {k: s / n for k, (n, s) in cells.items()}
        tau = max(np.mean([(m[k] - means[k]) ** 2 - m[k] * (1 - m[k]) / n for k, (n, _) in cells.items()]), 1e-6)
        return min(max(np.mean([means[k] * (1 - means[k]) for k in cells]) / tau - 1, 1), 1e6)

    hosts, cells = {}, {}
    for _, h, p, x in rows:
        for d, k in ((hosts, h), (cells, (h, p))):
            n, s = d.get(k, (0, 0.0))
            d[k] = (n + 1, s + x)
    mean = sum(r[3] for r in rows) / len(rows)
    kappa = strength(hosts, dict.fromkeys(hosts, mean))
    by_host = {h: (s + kappa * mean) / (n + kappa) for h, (n, s) in hosts.items()}
    inner = strength(cells, {k: by_host[k[0]] for k in cells})
    by_path = {k: (s + inner * by_host[k[0]]) / (n + inner) for k, (n, s) in cells.items()}
    logit = lambda x: np.log(min(max(x, 1e-4), 1 - 1e-4) / (1 - min(max(x, 1e-4), 1 - 1e-4)))
    for i, h, p, x in rows:
        want = 1 / (1 + np.exp(-(logit(x) + logit(by_path[h, p]) - logit(mean))))
        assert abs(got[i].p_quality - want) < 1e-9 and got[i].kept == (want >= 0.5)
        assert abs(got[i].host_posterior - by_host[h]) < 1e-9 and abs(got[i].path_posterior - by_path[h, p]) < 1e-9


def test_quality_learns_kinds_of_text(spark):
    """Keyboard mash and pill spam go, code and lines of capitals stay, as labelled; held-out texts of each kind."""
    rng = random.Random(8)
    prose = "the river ran past old stone walls and people of a small town who came to watch boats in spring".split()
    kinds = {
        "prose": (1, lambda: " ".join(rng.choices(prose, k=40)).capitalize() + "."),
        "capitals": (1, lambda: " ".join(rng.choices(prose, k=25)).upper() + "."),
        "code": (1, lambda: "\n".join(f"    {rng.choice('xyz')} = {rng.choice(['len', 'sum', 'max'])}({rng.choice(['rows', 'names'])}[{rng.randrange(9)}])  # {rng.choice(prose)}" for _ in range(8))),
        "mash": (0, lambda: " ".join("".join(rng.choices("asdfghjkl;qwer", k=rng.randrange(4, 12))) for _ in range(30))),
        "pills": (0, lambda: " ".join(rng.choices(["buy", "cheap", "pills", "now", "viagra", "$$$", "offer", "click", "here", "online"], k=40))),
    }
    rows = [(i, kinds[k][1](), k) for i, k in enumerate(rng.choices(sorted(kinds), k=900))]
    docs = spark.createDataFrame([(i, t, k, "x") for i, t, k in rows], "doc_id long, text string, kind string, lang string").withColumn("source", F.lit("s"))
    labels = spark.createDataFrame([(i, kinds[k][0]) for i, _, k in rows if i % 2], "doc_id long, quality int")
    out = quality.classify(docs, quality.fit(docs, labels)).join(docs.select("doc_id", "kind"), "doc_id").filter("doc_id % 2 = 0").collect()
    for k, (y, _) in kinds.items():
        assert np.mean([r.kept == bool(y) for r in out if r.kind == k]) > 0.97, k


def test_sparse_sites_stay_near_their_parents(spark):
    rows = [("big", "x", 0.9)] * 400 + [("bad", "x", 0.1)] * 400 + [("new", "x", 0.1)]
    sites = quality.posteriors(spark.createDataFrame(rows, "host string, path string, p double"))
    got = {r.host: r.path_posterior for r in sites.table.collect()}
    assert abs(got["big"] - 0.9) < 0.02 and abs(got["bad"] - 0.1) < 0.02
    assert got["new"] > got["bad"] + 0.05  # one document moves its site only part of the way from the mean
    assert abs(sites.mean - sum(r[2] for r in rows) / len(rows)) < 1e-9


def test_quality_of_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.fit(awkward, labels)
    assert model == quality.DocumentModel()
    out = quality.classify(awkward, model).collect()
    assert len(out) == awkward.count()
    assert {r.doc_id for r in out if not r.kept} >= {3, 4, 5}
    assert quality.classify(empty, model).count() == 0
    assert quality.keep_good(awkward, model).columns == awkward.columns


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (c > "4") for i, c in enumerate(reversed(d))) % 10 == 0


def brute_spans(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_the_patterns(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("a1.@ -+()9é_%2.5:\n") for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += ["1 " * 9000, "9" * 20000, "a" * 30000 + "@b.c", "a." * 9000, None, "", "😀a@b.c d😀 +12345678901", "1.2.3.4.5.6.7.8", "000000255.1.1.1 256.1.1.1 99999999999.1.1.1", "a@b.c_d@e.f", "4111 1111 1111 1111", "4111-1111-1111-1111 0000000000000"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.base] for r in pii.find_spans(df, ["doc_id"]).collect()}
    assert got == {i: brute_spans(t) for i, t in enumerate(texts)}


def test_labelers_and_classifier(spark):
    key = hashlib.sha1(b"x").hexdigest()
    texts = [f'say token = "{key[:-1]}{k % 10}" now' for k in range(60)] + [f"about version 12{k:02d} 3456 7890 it" for k in range(60)] + ["plain words only"] * 20
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = pii.train(pii.with_spans(df))
    spans = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if s.kind in pii.EXTRA_KINDS] for r in pii.find_spans(df, ["doc_id"], model=model).collect()}
    assert all(spans[i] == [("secret", 13, 53)] for i in range(60))
    assert not any(spans[i] for i in range(120, 140))
    rates = {name: (yes, no) for name, yes, no in model.reliability}
    assert set(rates) == set(pii.VOTES) and all(yes > no for yes, no in rates.values())


def test_a_reliable_labeler_overrules_a_majority():
    """Three labelers that guess and one that knows: EM believes the one, where a vote would not."""
    rng = random.Random(3)
    counts: dict = {}
    for _ in range(30000):
        y = rng.random() < 0.5
        sure = [(1 if y else -1) * (1 if rng.random() < 0.97 else -1) for _ in range(3)]
        guess = [rng.choice((-1, 1)) for _ in range(4)]
        v = (*sure, *guess)
        counts[v] = counts.get(v, 0) + 1
    post, table = pii.estimate(list(counts.items()), 500)
    assert post[(1, 1, 1, -1, -1, -1, -1)] > 0.9 and post[(-1, -1, -1, 1, 1, 1, 1)] < 0.1
    assert all(abs(table[k][1][1] - 0.5) < 0.05 for k in range(3, 7))


def test_labelers_disagree_and_the_gazetteer_is_a_table(spark):
    texts = ["my ssn 123-45-6789 ok", "page 123-45-6789 ok", "mr smith 555-123-4567 here", "12 main street 555 123 4567 here", "id 000-12-3456 x", "kennwort q7w8e9r0t1y2u3i4o5 x", "abc " + "a" * 65 + "1" * 20 + " end"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    votes = lambda found: {r.doc_id: [tuple(c[f"v{i}"] for i in range(len(pii.VOTES))) for c in r["__cand"]] for r in found.collect()}
    got = votes(pii.with_spans(df))
    at = {v: i for i, v in enumerate(pii.VOTES)}
    assert got[0][0][at["gazetteer"]] == 1 and got[1][0][at["gazetteer"]] == -1 and got[1][0][at["pattern"]] == 1
    assert got[2][0][at["name"]] == 1 and got[3][-1][at["address"]] == 1 and got[4][0][at["identifier"]] == -1 and got[0][0][at["identifier"]] == 1
    assert got[5][0][at["gazetteer"]] == 0 and len(got[6]) == 1  # a digit after 65 letters is seen
    table = spark.createDataFrame([("Kennwort", "secret", 1), (None, "any", 1), ("page", None, -5)], "phrase string, kind string, vote int")
    entries = pii.gazetteer_of(table)
    assert entries == (("kennwort", "secret", 1), ("page", "any", -1))
    got = votes(pii.with_spans(df, gazetteer=entries))
    assert got[5][0][at["gazetteer"]] == 1 and got[1][0][at["gazetteer"]] == -1 and got[0][0][at["gazetteer"]] == 0
    long = spark.createDataFrame([(0, "my international bank account number: 1234 5678 9012"), (1, "my account: 1234 5678 9012")], "doc_id long, text string")
    got = votes(pii.with_spans(long, gazetteer=(("international bank account number", "number", 1),)))
    assert got[0][0][at["gazetteer"]] == 1 and got[1][0][at["gazetteer"]] == 0


def test_a_gazetteer_of_any_size_is_joined(spark):
    texts = ["my ssn 123-45-6789 ok", "page 123-45-6789 ok", "the api key: q7w8e9r0t1y2u3i4o5", "apikey=q7w8e9r0t1y2u3i4o5", "API_KEY q7w8e9r0t1y2u3i4o5, page q1w8e9r0t1y2u3i4o5", "rapikey q7w8e9r0t1y2u3i4o5", "international bank account number 1234 5678 9012", None, "", "mail a@b.co phone 555 123 4567"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    entries = (*pii.GAZETTEER, ("international bank account number", "number", 1))
    votes = lambda found: {r.doc_id: [(c["kind"], c["start"], *(c[f"v{i}"] for i in range(len(pii.VOTES)))) for c in r["__cand"]] for r in found.collect()}
    want = votes(pii.with_spans(df, gazetteer=entries))
    many = spark.range(20_000).select(F.concat(F.lit("name "), F.col("id").cast("string")).alias("phrase"), F.lit("any").alias("kind"), F.lit(1).alias("vote"))
    table = spark.createDataFrame([*entries, (None, "any", 1), ("x", "any", None), ("--", "any", 1)], "phrase string, kind string, vote int").unionByName(many)
    found = pii.with_spans(df, gazetteer=table)
    assert found.columns == pii.with_spans(df).columns
    assert votes(found) == want and any(v[3] == 1 for c in want.values() for v in c) and any(v[3] == -1 for c in want.values() for v in c)
    named = spark.createDataFrame([(0, "name 19999 has 555 123 4567"), (1, "nome 19999 has 555 123 4567")], "doc_id long, text string")
    got = votes(pii.with_spans(named, gazetteer=table))
    assert got[0][0][3] == 1 and got[1][0][3] == 0
    assert pii.find_spans(df, ["doc_id"], gazetteer=table).count() == len(texts) and pii.redact(df, gazetteer=table).columns == df.columns


def test_texts_with_very_many_matches(spark):
    text = "a@b.c 1.2.3.4 " * 3000
    r = pii.find_spans(spark.createDataFrame([(1, text)], "doc_id long, text string"), ["doc_id"]).first()
    assert [(s.kind, s.start, s.end) for s in r.base] == brute_spans(text)


def test_expectation_maximisation_finds_reliabilities():
    rng = random.Random(1)
    right = (0.95, 0.9, 0.6, 0.7, 0.8, 0.65, 0.75)
    counts: dict = {}
    for _ in range(20000):
        y = rng.random() < 0.4
        v = tuple((1 if y else -1) * (1 if rng.random() < r else -1) for r in right)
        counts[v] = counts.get(v, 0) + 1
    _, table = pii.estimate(list(counts.items()), 500)
    for k, r in enumerate(right):
        assert abs(table[k][1][1] - r) < 0.05 and abs(table[k][0][-1] - r) < 0.05


def test_redaction(spark, awkward, empty):
    model = pii.train(pii.with_spans(awkward))
    out = {(r.doc_id, r.n_chars): r.text for r in pii.redact(awkward, model).collect()}
    assert out[(10, 1)] == "😀 mail [EMAIL] and [PHONE], é" and out[(3, None)] is None and out[(4, 0)] == ""
    assert next(t for (i, _), t in out.items() if i == 6).endswith("card [CARD] end")
    assert pii.redact(awkward, model).columns == awkward.columns
    assert sorted(map(str, pii.redact(awkward).collect())) == sorted(map(str, pii.redact(awkward, model).collect()))
    assert pii.redact(empty, model).count() == 0 and pii.find_spans(empty, ["doc_id"]).count() == 0


def test_schedule_keeps_every_source_within_a_block():
    rng = random.Random(3)
    for _ in range(30):
        sources = {f"s{k}": rng.randrange(1, 200) for k in range(rng.randrange(1, 9))}
        plan = mixing.phases(sources, {s: rng.random() + 0.01 for s in sources}, 97)
        slots = {}
        for s, n in sources.items():
            for i in range(n):
                p = next(p for p in reversed(plan) if s in p.blocks and p.blocks[s] <= i)
                slots[mixing.place(p, s, i)] = s
        assert sorted(slots) == list(range(sum(sources.values())))
        for p, after in zip(plan, [*plan[1:], None], strict=True):
            gone = dict.fromkeys(p.slots, 0)
            for t in range(p.slot, after.slot if after else len(slots)):
                gone[slots[t]] += 1
                for s, n in gone.items():
                    assert abs(n - (t + 1 - p.slot) * len(p.slots[s]) / p.period) < 1


def test_mix_places_every_row_once(spark, awkward, empty):
    rows = [(i, "abc"[min(2, i % 7)], i) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, slot long")
    out = mixing.schedule(df, {"a": 0.5, "b": 0.3, "c": 0.2}, block_rows=16, period=10).collect()
    assert sorted(r.doc_id for r in out) == list(range(3000))
    by_slot: dict = {}
    for r in out:
        by_slot.setdefault(r.slot, []).append(r)
    assert all(len({(r.source, r.block) for r in v}) == 1 and sorted(r.place for r in v) == list(range(len(v))) for v in by_slot.values())
    first = [by_slot[t][0].source for t in range(20)]
    assert (first.count("a"), first.count("b"), first.count("c")) == (10, 6, 4)
    assert mixing.schedule(awkward).count() == awkward.count()
    assert mixing.schedule(empty).count() == 0
    again = {r.doc_id: r.slot for r in mixing.schedule(df.repartition(9), {"a": 0.5, "b": 0.3, "c": 0.2}, block_rows=16, period=10).collect()}
    assert again == {r.doc_id: r.slot for r in out}
    with pytest.raises(KeyError):
        mixing.schedule(df, {"a": 1.0})


def test_mix_follows_the_target_weights_themselves(spark):
    df = spark.createDataFrame([(i, f"s{i % 28:02}" if i % 28 < 19 else "a") for i in range(8000)], "doc_id long, source string")
    sizes = {r["source"]: r["count"] for r in df.groupBy("source").count().collect()}
    out = sorted((r.slot, r.source, r.release, r.deadline) for r in mixing.schedule(df, block_rows=1).collect())
    assert [x[0] for x in out] == list(range(8000)) and all(release <= slot < deadline for slot, _, release, deadline in out)
    weights, gone = mixing.default_weights(sizes), dict.fromkeys(sizes, 0)
    for slot, source, _, _ in out:  # as long as every source has rows
        gone[source] += 1
        assert all(abs(n - (slot + 1) * weights[s] / sum(weights.values())) < 1 for s, n in gone.items())
        if any(n == sizes[s] for s, n in gone.items()):
            break
    assert slot > 3000
    plan = mixing.fluid({"big": 9000, "rare": 2, "none": 3}, {"big": 1.0, "rare": 0.0002, "none": 0})
    assert [t for t, _, _ in plan["rare"]][0] < 5001 <= [t for t, _, _ in plan["rare"]][1] and [t for t, _, _ in plan["none"]] == [9002, 9003, 9004]


def test_mix_of_any_number_of_sources(spark):
    df = spark.createDataFrame([(i, f"s{i % 1500}") for i in range(4000)], "doc_id long, source string")
    out = mixing.schedule(df, block_rows=2).collect()
    assert sorted(r.doc_id for r in out) == list(range(4000))
    slots = {(r.source, r.block): r.slot for r in out}
    assert sorted(slots.values()) == list(range(2500)) and all(r.slot == slots[r.source, r.block] for r in out)


def test_rows_without_ids_are_spread_and_blocks_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_BLOCKS", 20)
    df = spark.createDataFrame([(None if i % 3 else 7, "ab"[i % 2], i) for i in range(4000)], "doc_id long, source string, n long")
    out = mixing.schedule(df, bucket_rows=100).collect()
    assert sorted(r.n for r in out) == list(range(4000)) and {r.place for r in out} == set(range(200))
    assert sorted({r.slot for r in out}) == list(range(20))
    again = {r.n: (r.slot, r.place) for r in mixing.schedule(df.repartition(7), bucket_rows=100).collect()}
    assert again == {r.n: (r.slot, r.place) for r in out}


def test_mixed_rows_come_in_order(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(640)], "doc_id long, source string")
    slots = {r.doc_id: r.slot for r in mixing.schedule(df).collect()}
    order = [slots[r.doc_id] for r in mixing.mixed(df).collect()]
    assert order == sorted(order)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(q.VOCABULARY)
    t.no_truncation()
    t.no_padding()
    return t


def test_tokens_equal_the_library(library):
    own = bpe.tokenizer(q.VOCABULARY)
    rng = random.Random(1)
    ranges = [(32, 127), (0x80, 0x2FF), (0x300, 0x370), (0x370, 0x600), (0x2000, 0x2100), (0x4E00, 0x4E10), (0x1F600, 0x1F610), (9, 14)]
    texts = ["".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(30))) for _ in range(1500)]
    texts += ["", " ", "Hello <|endoftext|> World<|startoftext|>x", "don't I'll He'S", "ΑΣ ΣΑΣ İstanbul", "日本語123 ½", "a" * 600, "ab" * 5000, "\u1c89 \ua7cb"]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        got = own.encode(t)
        assert list(struct.unpack(f"<{len(got) // 4}I", got)) == ids
        assert own.decode(got) == library.decode(ids, skip_special_tokens=False)


def test_long_words_are_merged_in_blocks(library, monkeypatch):
    own = bpe.tokenizer(q.VOCABULARY)
    rng = random.Random(2)
    for size in (1, 2, 5, 16):
        monkeypatch.setattr(bpe, "BLOCK", size)
        for _ in range(150):
            symbols = rng.choices("thean ringe", k=rng.randrange(1, 60))
            assert own.merge_blocks(symbols) == naive_merge(own.rank, symbols)
    monkeypatch.undo()
    for text in ("".join(rng.choices("theanringeo", k=30_000)), "a" * 20_000, "the" * 3000 + "é" * 3000):
        ids = library.encode(text, add_special_tokens=False).ids
        got = own.encode(text)
        assert list(struct.unpack(f"<{len(got) // 4}I", got)) == ids


def naive_merge(rank, parts):
    parts = list(parts)
    while True:
        found = [(rank[p], k) for k, p in enumerate(zip(parts, parts[1:], strict=False)) if p in rank]
        if not found:
            return parts
        k = min(found)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_files_of_another_kind_are_refused():
    import json

    with open(q.VOCABULARY, encoding="utf-8") as f:
        spec = json.load(f)
    bpe.check(spec)
    for part, value in (("decoder", {"type": "BPEDecoder", "suffix": "</w>"}), ("normalizer", {"type": "NFKC"}), ("normalizer", None), ("pre_tokenizer", {"type": "Whitespace"}), ("model", spec["model"] | {"byte_fallback": True})):
        with pytest.raises(ValueError):
            bpe.check(spec | {part: value})


def test_tokens_of_awkward_rows(awkward, empty):
    out = bpe.encode_decode(awkward.withColumn("ids", F.lit("clash")), q.VOCABULARY)
    rows = out.collect()
    assert len(rows) == awkward.count() and "decoded" in out.columns
    assert {r.doc_id for r in rows if len(r.ids) == 0} == {3, 4, 5}
    assert all(isinstance(r.ids, (bytes, bytearray)) for r in rows)
    assert bpe.encode_decode(empty, q.VOCABULARY).count() == 0


def test_rows_that_are_all_equal_are_numbered_by_many_tasks(spark):
    """One source's rows without an id: one hash. Each gets a place of its own, in ranges of a bounded size."""
    from strandloom.llm import mixing

    n = 9000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("source"))
    out = mixing.schedule(df, bucket_rows=100)
    rows = out.select("source", "block", "slot", "place").collect()
    for source, size in (("a", 6000), ("b", 3000)):
        assert sorted((r.block, r.place) for r in rows if r.source == source) == [(k // 64, k % 64) for k in range(size)]
    assert len({(r.slot, r.place) for r in rows}) == n
    again = {tuple(r) for r in mixing.schedule(df.repartition(5), bucket_rows=100).collect()}
    assert again == {tuple(r) for r in out.collect()}
