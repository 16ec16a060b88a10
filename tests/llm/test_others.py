"""Vectors, URLs, conversations and the pipeline."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strandloom.llm import ann, chat, embeddings, urls
from strandloom.llm import queries as q

VEC = "vec_id long, embedding array<float>, n_links string"


def vectors(spark, n=240, dim=24, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n // 6, dim))
    x = np.vstack([b + rng.standard_normal((6, dim)) * s for b, s in zip(base, rng.choice([0.0, 0.2, 0.33, 0.5], len(base)), strict=True)]).astype(np.float32)
    x[7] = x[6] * 3
    return x, spark.createDataFrame([(i, v.tolist(), "clash") for i, v in enumerate(x)], VEC)


@pytest.mark.parametrize("tile", [16, 4096])
def test_embedding_links_equal_brute_force(spark, tile):
    x, df = vectors(spark)
    d = x.astype(float)
    n = np.linalg.norm(d, axis=1)
    link = (d @ d.T) / (n[:, None] * n[None]) >= 0.9
    np.fill_diagonal(link, False)
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.minimum(label, np.where(link, label[None], len(x)).min(1))
    got = {r.vec_id: r for r in embeddings.near_duplicates(df, tile_rows=tile).collect()}
    assert [got[i].n_links for i in range(len(x))] == link.sum(1).tolist()
    assert [got[i].component_id for i in range(len(x))] == label.tolist()


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(3)
    x, y = rng.standard_normal((200, 40)), rng.standard_normal((200, 40)) * rng.random((200, 1)) ** 6
    (qa, sa, na, ea), (qb, sb, nb, eb) = embeddings.quantise(x), embeddings.quantise(y)
    assert qa.dtype == qb.dtype == np.int8
    near = (qa.astype(int) * qb).sum(1) * sa * sb
    assert (np.abs(near - embeddings.cosines(x, y)) <= ea * nb + na * eb + ea * eb).all()


BAD = [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] * 24), (904, [float("inf")] + [1.0] * 23), (905, [None] + [1.0] * 23), (906, [1.0, 2.0])]


def test_vectors_that_take_no_part(spark):
    x, df = vectors(spark, 60)
    bad = spark.createDataFrame([(i, v, None) for i, v in BAD], VEC)
    got = {r.vec_id: r for r in embeddings.near_duplicates(df.union(bad)).collect()}
    assert len(got) == 67 and all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i, _ in BAD)
    twice = embeddings.near_duplicates(df.union(df).filter("vec_id = 11")).collect()
    assert [r.n_links for r in twice] == [1, 1]
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
    found = ann.nearest(df.union(bad), F.col("vec_id") % 30 == 0)
    ids = {r.query_id for r in found.collect()} | {r.vec_id for r in found.collect()}
    assert not ids & {i for i, _ in BAD}
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0
    assert ann.nearest(df.filter("vec_id < 4"), F.col("vec_id") == 0).count() == 3  # fewer candidates than k


@pytest.mark.parametrize("pilot", [1, 4])
def test_nearest_equal_brute_force(spark, monkeypatch, pilot):
    monkeypatch.setattr(ann, "PILOT", pilot)  # of five blocks, one gives a first limit, or none
    monkeypatch.setattr(ann, "BLOCK_ROWS", 50)
    monkeypatch.setattr(ann, "QUERY_ROWS", 7)
    x, df = vectors(spark, 480)
    d = x.astype(float)
    got: dict = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = 0
    for i in range(0, 480, 20):
        dist = np.sqrt(((d - d[i]) ** 2).sum(1))
        order = [k for k in np.lexsort((np.arange(480), dist)) if k != i][:10]
        assert [got[i][k][1] for k in range(1, 11)] == sorted(got[i][k][1] for k in range(1, 11))
        assert all(got[i][k][1] == pytest.approx(dist[got[i][k][0]], abs=1e-12) for k in range(1, 11))
        hits += len({v for v, _ in got[i].values()} & set(order))
    assert hits / (10 * 24) >= 0.98


def test_one_bit_bounds_hold_and_spare_most_vectors():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((4000, 64))
    q, centre = x[:20] + 0.05, x.mean(0)
    codes, norm, f = ann.encode(x, centre, ann.rotation(64))
    assert codes.shape == (4000, ann.CODE_BITS // 8)
    tried = wrong = 0
    for row, (near, least) in zip(q, ann.bounds(codes, norm, f, q, centre), strict=True):
        d2 = ((x - row) ** 2).sum(1)
        wrong += (least > d2).sum()
        tried += (least <= np.sort(d2)[9]).sum()
        assert np.abs(near - d2).max() < 0.5 * d2.max()
    assert wrong <= 0.005 * 20 * 4000 and tried < 0.4 * 20 * 4000


def test_hot_vectors_and_repeated_ids_in_a_search(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((60, 8)).astype(np.float32)
    rows = [(i, x[0 if i % 3 == 0 else i].tolist(), None) for i in range(60)] + [(61, x[0].tolist(), None), (61, x[5].tolist(), None)]
    df = spark.createDataFrame(rows, VEC)
    got: dict = {}
    for r in ann.nearest(df.union(df), F.col("vec_id") % 6 == 0, k=4).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for i in range(0, 60, 6):  # twenty equal vectors: the smallest ids, without the query's own
        assert sorted(got[i]) == [(n + 1, v, 0.0) for n, v in enumerate([v for v in range(0, 60, 3) if v != i][:4])]
    both = ann.nearest(df, F.col("vec_id") == 5, k=60).collect()
    assert [r.score for r in both if r.vec_id == 61] == [0.0] and len(both) == 60


def test_extreme_magnitudes(spark):
    v = [[1.0, 2.0, 3.0], [1.0, 2.0, 3.0001], [3.0, -2.0, 1.0]]
    rows = [(3 * e + k, [c * scale for c in v[k]], None) for e, scale in enumerate((1e200, 1e-200, 1.0, 1e-310)) for k in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df).collect()}
    assert got == {i: (7, 0) if i % 3 < 2 else (3, 2) for i in range(12)}
    found = ann.nearest(df, F.col("vec_id") == 0, k=3).collect()
    assert [(r.rank, r.vec_id) for r in sorted(found, key=lambda r: r.rank)] == [(1, 1), (2, 3), (3, 4)]


def test_open_pairs_are_computed_in_double(spark):
    """Vectors around the threshold, whose codes decide nothing."""
    rng = np.random.default_rng(12)
    base = rng.standard_normal(16)
    base /= np.linalg.norm(base)
    x = []
    for k in range(120):
        side = rng.standard_normal(16)
        side -= side @ base * base
        side /= np.linalg.norm(side)
        c = 0.9 + (k - 59.5) * 1e-5
        x.append(c * base + np.sqrt(1 - c * c) * side)
    x = np.array([base, *x])
    n = np.linalg.norm(x, axis=1)
    link = (x @ x.T) / (n[:, None] * n[None]) >= 0.9
    np.fill_diagonal(link, False)
    df = spark.createDataFrame([(i, v.tolist(), None) for i, v in enumerate(x)], "vec_id long, embedding array<double>, n_links string")
    for tile in (7, 4096):
        got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(df, tile_rows=tile).collect()}
        assert [got[i] for i in range(len(x))] == link.sum(1).tolist()


def fits(rule, text):
    """Whether a pattern rule fits somewhere in a text, by trying every place; ``^`` is a separator or an end."""

    def here(i, j):
        while i < len(rule):
            if rule[i] == "*":
                return any(here(i + 1, k) for k in range(j, len(text) + 1))
            if rule[i] == "^":
                edge = (j == 0 or j == len(text) or (j == len(text) - 1 and text[j] == "\n")) and here(i + 1, j)
                if edge or j == len(text) or text[j] in "abcdefghijklmnopqrstuvwxyz0123456789":
                    return edge
            elif j == len(text) or text[j] != rule[i].lower():
                return False
            i, j = i + 1, j + 1
        return True

    return any(here(0, j) for j in range(len(text) + 1))


def brute_url(url, patterns, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "") if "://" in (url or "") else None
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    hit = next((p for p in patterns if fits(p, (url or "").lower())), None)
    best = max(fit, key=lambda r: len(r.text), default=None)
    return host, path, best.text if best else None, best.verdict if best else "block" if hit else "allow", hit


@pytest.mark.parametrize("literal_rules", [20_000, 0])
def test_url_rules_equal_brute_force(spark, literal_rules):
    rng = random.Random(6)
    parts = ["casino", "ads", "track", "ads-track", "cheap-pills", "example", "net", "org", "com", "EN", "fr", "x"]
    made = [f"{rng.choice(['http', 'HTTPS'])}{rng.choice(['://', ':/', '://', '://'])}{'.'.join(rng.choices(parts, k=3))}{rng.choice(['', '/', '/en/', '/fr/', '/de/'])}{'/'.join(rng.choices(parts, k=2))}{rng.choice(['', '?q=://a/b', '#casino'])}" for _ in range(600)]
    made += [None, "", "://", "a://b", "http://net", "http://NET/", "http://fr.org/fr/x", "x://y://z/a", "http://a.b\nc/d", "http://track/x\ny/pills", "http://a..net/", "casino\n", "http://long/" + "x/" * 40_000]
    patterns = (*urls.BLOCK_PATTERNS, "^track*pills", "^track*^pills^", "ads*", "*")[:-1]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate([*made, made[0], made[0]])], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.pattern) for r in urls.filter_urls(df, patterns, q.URL_RULES, literal_rules=literal_rules).collect()}
    assert got == {i: brute_url(u, patterns, q.URL_RULES) for i, u in enumerate([*made, made[0], made[0]])}
    assert got[609][4] == "^track*pills"
    assert urls.filter_urls(df.limit(0), patterns, q.URL_RULES, literal_rules=literal_rules).count() == 0
    assert urls.filter_urls(df, ()).filter("verdict = 'block'").count() == 0


def test_any_number_of_url_rules(spark):
    patterns = [f"^r{k}^" for k in range(urls.LITERAL_RULES + 5)]
    hosts = [urls.HostRule("block" if k % 2 else "allow", f"h{k}.net", "/a") for k in range(3000)]
    df = spark.createDataFrame([(0, "http://x/r20003?q"), (1, "http://b.h7.net/abc"), (2, "http://h8.net/a/r5"), (3, None), (4, "http://h9.net/r5/")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict, r.pattern) for r in urls.filter_urls(df, patterns, hosts).collect()}
    assert got == {0: (None, "block", "^r20003^"), 1: ("h7.net/a", "block", None), 2: ("h8.net/a", "allow", "^r5^"), 3: (None, "allow", None), 4: (None, "block", "^r5^")}


def test_rarest_token_indexes_a_rule():
    assert urls.literal_tokens("^cheap-pills^") == ["cheap", "pills"]
    assert urls.literal_tokens("cheap*") == [] and urls.literal_tokens("^a*b^c^") == ["c"]


def test_url_plan_is_native_and_narrow(spark):
    plan = urls.filter_urls(spark.createDataFrame([(1, "http://a/b")], "page_id long, url string"))._jdf.queryExecution().toString()
    assert "Exchange" not in plan.split("Physical Plan")[1] and "Python" not in plan


NASTY = ["", "\\", "###", "####", "</turn>", "\\</turn>", "### Assistant: </turn> ok", r"\### Assistant: </turn> ok", "<|image:0|>", "\\<|", "a\nb", "\\n", "</turn>\n### user\n", "é😀"]


def test_escapes_are_reversible():
    rng = random.Random(7)
    for _ in range(2000):
        t = "".join(rng.choices([*NASTY, "x", "\n", "#", "<", "|"], k=rng.randrange(6)))
        assert chat.unescape(chat.escape(t)) == t and chat.unescape(chat.escape(t, True)) == t
        out = chat.format_turn(t, [{"kind": "text", "text": t}])
        (role, content, s, e), *rest = chat.parse(out[0] * 2)
        assert (role, chat.unescape(content), len(rest)) == (t, t, 1)
        assert out[0][out[1] : out[2]] == content and (s, e) == out[1:3]


def test_conversations_read_back(spark):
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", None, "a\nb"]), rng.choice([None, *NASTY])) for c in (1, 2, None, 5) for t in range(rng.randrange(1, 9))]
    rows += [(7, 0, "assistant", "y"), (7, 0, "assistant", "y"), (7, None, "user", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit("clash"))
    for size in (1, 1 << 20):
        got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df, piece_chars=size)).collect()}
        for c in {r[0] for r in rows}:
            turns = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
            said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
            loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
            assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_typed_parts_become_placeholders(spark):
    parts = [("text", "see <|image:0|> ", None, None), ("image", None, "s3://x", 4), ("audio", None, "f.wav", 10), ("document", None, None, None), ("text", "end", None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts {chat.PART_TYPE}")
    r = chat.format_conversations(df).first()
    _, content, _, _ = next(chat.parse(r.formatted))
    assert chat.attachments(content) == [("image", 0), ("audio", 1), ("document", 2)]
    assert [(a.kind, a.ref, a.tokens) for a in r.attachments] == [("image", "s3://x", 1024), ("audio", "f.wav", 250), ("document", None, 512)]
    assert r.tokens_expanded == 1786 and chat.unescape(content.split("<|image:0|>")[0]) .startswith("see ")


def test_parts_of_unknown_kinds_and_null_parts(spark):
    parts = [("video", "said", "v.mp4", 3), None, (None, "plain <|other:0|>", None, None), ("text", None, None, None), ("visit_other", None, None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None), (1, 2, "assistant", [])], f"conv_id long, turn long, role string, parts {chat.PART_TYPE}")
    pieces = chat.format_conversations(df)
    r = pieces.first()
    turns = list(chat.parse(r.formatted))
    assert chat.attachments(turns[0][1]) == [("other", 0), ("other", 1)] and [t[1] for t in turns[1:]] == ["", ""]
    assert [(a.turn, a.kind, a.ref, a.tokens) for a in r.attachments] == [(0, "video", "v.mp4", 0), (0, "visit_other", None, 0)]
    assert chat.read_back(pieces).first().n_turns == 3


def test_sql_oracles(spark, sf_dir):
    import glob
    import os

    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    for name, sql in q.oracle_sql().items():
        got = q.queries()[name](spark, sf_dir).toPandas()
        want = con.execute(sql).df()
        cols = sorted(got.columns)
        assert cols == sorted(want.columns)
        # Whole numbers beside nulls are floats in one table and integers in the other.
        cell = lambda x: int(x) if isinstance(x, float) and x.is_integer() else x
        text = lambda df: sorted(str(tuple(map(cell, r))) for r in df[cols].astype(object).where(df[cols].notna(), None).itertuples(index=False, name=None))
        assert text(got) == text(want), name


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    kept = corpus_pipeline.quality_stage(spark, docs, sf_dir)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert all(labels[i] == 1 for i in ids(kept) if i in labels)
    assert all(i in ids(kept) for i, g in labels.items() if g == 1)
    one = corpus_pipeline.near_duplicate_stage(spark, kept, sf_dir)
    from test_documents import brute_components

    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert ids(one) == {i for i, c in brute_components(rows, corpus_pipeline.NEAR_PERCENT).items() if i == c}
    clean = corpus_pipeline.personal_data_stage(spark, one, sf_dir)
    assert ids(clean) == ids(one) and clean.columns == corpus_pipeline.COLUMNS
    from test_documents import brute_spans

    assert not any(brute_spans(r.text) for r in clean.collect())
    mix = corpus_pipeline.mixing_stage(spark, clean, sf_dir)
    assert ids(mix) == ids(one) and mix.columns == corpus_pipeline.COLUMNS
    out = corpus_pipeline.token_stage(spark, mix, sf_dir)
    assert ids(out) == ids(one)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "MinHash near-dedup", "PII", "mixing sources", "BPE encoding"]
    whole = corpus_pipeline.run(spark, sf_dir).select("doc_id", "n_tokens", "decoded_sha256")
    assert {tuple(r) for r in whole.collect()} == {tuple(r) for r in out.select("doc_id", "n_tokens", "decoded_sha256").collect()}


def test_pipeline_stages_take_awkward_and_empty_tables(spark, awkward, empty, sf_dir):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0, name
    known = lambda df: sorted(((r.doc_id, r.text, r.source) for r in df.collect()), key=str)
    all_rows = known(awkward)
    stages = dict(corpus_pipeline.STAGES)
    kept = known(stages["quality classifier"](spark, awkward, sf_dir))
    assert set(kept) <= set(all_rows) and not any(t is None or not t.strip() for _, t, _ in kept)
    one = known(stages["MinHash near-dedup"](spark, awkward, sf_dir))
    # 1, its repeat, 2 and the row without an id are copies; 6 and 7, and 8 and 9, near-copies; texts without words stay.
    assert sorted((i, str(t)[:5]) for i, t, _ in one) == sorted([(1, "One t"), (3, "None"), (4, ""), (5, " \n\t "), (6, "Lorem"), (8, "short"), (10, "😀 mai")])
    clean = stages["PII"](spark, awkward, sf_dir)
    assert clean.count() == len(all_rows) and [(r.text, r.n_chars) for r in clean.filter("doc_id = 3 or doc_id = 4").orderBy("doc_id").collect()] == [(None, None), ("", 0)]
    assert known(stages["mixing sources"](spark, awkward, sf_dir)) == all_rows
    out = {r.doc_id: r for r in stages["BPE encoding"](spark, awkward, sf_dir).collect()}
    assert {i for i, r in out.items() if r.n_tokens == 0} == {3, 4, 5}


def test_the_mix_lasts_through_files(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mix = corpus_pipeline.mixing_stage(spark, docs, sf_dir)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files, however few rows
    mix.write.parquet(str(tmp_path / "mix"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    order = [r.doc_id for r in mix.coalesce(1).collect()]
    again = spark.read.parquet(str(tmp_path / "mix"))
    out = corpus_pipeline.token_stage(spark, again, sf_dir)
    placed = out.select("doc_id", "mix_part", "mix_row").collect()
    assert [r.doc_id for r in sorted(placed, key=lambda r: (r.mix_part, r.mix_row))] == order
    assert len({r.mix_part for r in placed}) > 1
    bare = corpus_pipeline.token_stage(spark, spark.createDataFrame([(1, "a", "en", "s", 1)], docs.schema), sf_dir).first()
    assert (bare.mix_part, bare.mix_row, bare.doc_id) == (None, None, 1)


def test_ids_at_the_end_of_their_range(spark, sf_dir):
    most, a, b = (1 << 63) - 1, *(" ".join(f"{x}{k}" for k in range(30)) for x in "ab")
    rows = [(most, a, "en", "s", 1), (most, b, "en", "s", 1), (-7, b + " more", "en", "s", 1), (None, a + " end", "en", "s", 1), (3, "quite another text, on its own", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicate_stage(spark, docs, sf_dir).collect()
    kept = {(r.doc_id, r.text) for r in got}
    assert (-7, rows[2][1]) in kept and (3, rows[4][1]) in kept and len(kept) == 3 and not any(t == b for _, t in kept)


def test_the_sample_is_read_by_as_many_tasks_as_there_are_files(spark, sf_dir, tmp_path):
    from strandloom.llm import quality

    spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(20).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.option("maxRecordsPerFile", 1).parquet(str(tmp_path / "docs"))
    seen = []
    group = f"sample-{tmp_path.name}"
    spark.sparkContext.setJobGroup(group, group)
    quality.fit(docs.repartition(20), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    tracker = spark.sparkContext.statusTracker()
    for job in tracker.getJobIdsForGroup(group):
        seen += [tracker.getStageInfo(s).numTasks for s in tracker.getJobInfo(job).stageIds if tracker.getStageInfo(s)]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(seen) >= 20


def test_rows_of_one_id_with_different_texts_all_count(spark, sf_dir):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(5, a, "en", "s", 1), (5, b, "en", "s", 1), (5, b, None, "s", 1), (2, b + " more", "en", "s", 1), (9, c, "en", "s", 1), (None, c, "en", "s", 1), (None, "only here in this row without id", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicate_stage(spark, docs, sf_dir).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(5, a), (2, b + " more"), (9, c), (None, rows[-1][1])], key=str)
    twice = docs.union(docs).filter("doc_id = 9 or doc_id is null")
    got = corpus_pipeline.near_duplicate_stage(spark, twice, sf_dir).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(9, c), (None, rows[-1][1])], key=str)
