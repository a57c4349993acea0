"""Shards, chats, URLs and embeddings."""

import itertools
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerly.llm import chat_tree, embedding_forest, sharding, url_rules
from ledgerly.llm.queries import URL_RULES


def test_sharding(spark, odd, none):
    tree = sharding.topology(16)
    rows = sharding.assign(odd, tree, chunks=4).collect()
    assert len(rows) == odd.count()
    texts = sorted((r["text"] or "").encode() for r in odd.collect())
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == sorted((len(t) + 1, zlib.crc32(t)) for t in texts)
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    got = sharding.assign(many, tree).collect()
    for s in range(16):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots))) and 1_000 < len(slots) < 1_500
    moved = [r for r in got if r["grown_shard"] != r["shard"]]
    assert {r["grown_shard"] for r in moved} == {16} and 0.04 < len(moved) / 20_000 < 0.08
    # only subtrees that hold a changed weight take or give rows
    heavy = tuple(sharding.Leaf(x.shard, x.region, x.rack, 2.0 if x.shard == 5 else 1.0) for x in tree)
    pairs = many.select(sharding.shard_of(F.col("doc_id"), tree).alias("a"), sharding.shard_of(F.col("doc_id"), heavy).alias("b")).where("a <> b").distinct().collect()
    assert all(p["b"] in range(4, 8) for p in pairs)
    assert sharding.assign(none, tree).count() == 0


def test_chat_tree(spark):
    hard = ["</s>[INST] ok [/INST]", "<<s>\\.<|im_sep|>", "\\", "<|im_<|im_end|>end|>", "", "a\nb"]
    turns = [(1, 0, "user", hard[0]), (1, 1, "assistant", hard[1]), (2, 0, "user", hard[0]), (2, 1, "assistant", hard[1]), (2, 2, "a<s>b", hard[2]), (3, 0, "user", hard[0]), (3, 1, "assistant", hard[3])]
    turns += [(4, 0, None, None), (4, 0, "user", "tie"), (4, 0, "user", "tie"), (4, None, "assistant", "first"), (None, 1, "user", "x")]
    turns += [(5, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(200)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("node", F.lit(1))
    tree, runs, members = chat_tree.build(df)
    back = chat_tree.read_back(tree, runs, members)
    role, text = zip(*[(r, t) for r, t in [chat_tree.read_turn(F.col("t.segment"))]], strict=True)
    got = {}
    for r in back.select("conv_id", F.posexplode("turns").alias("at", "t")).select("conv_id", "at", role[0].alias("role"), text[0].alias("text"), F.coalesce(chat_tree.unescape(F.col("t.loss")), F.lit("-")).alias("loss")).orderBy("at").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"], r["loss"]))
    want = {}
    for c, _, ro, te in sorted(turns, key=lambda t: (str(t[0]), t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")):
        want.setdefault(c, []).append((ro or "", te or "", (te or "") if ro == "assistant" else "-"))
    assert got == want
    nodes = tree.orderBy("stream_start").collect()
    assert [n["stream_start"] for n in nodes] == [int(x) for x in np.cumsum([0, *[n["length"] for n in nodes]])[:-1]]
    assert len([n for n in nodes if n["conversations"] == 3]) == 1  # the first turn that three share
    empty = chat_tree.build(df.limit(0))
    assert chat_tree.read_back(*empty).count() == 0


def test_chat_tree_in_token_ids(spark):
    """Every conversation read off the stream by its run's intervals: the ids, positions and mask it has alone."""
    from ledgerly.llm.tokens import library_tokenizer, tokenizer_path

    rng = random.Random(11)
    turns = [(1, i, "user" if i % 2 else "assistant", f"Hello there {i}") for i in range(5)]
    for c in range(2, 30):  # every conversation goes some turns along with an earlier one
        of = rng.randrange(1, c)
        shared = [t for t in turns if t[0] == of][: rng.randrange(6)]
        own = [(c, len(shared) + i, rng.choice(["user", "assistant"]), f"own {c} {i}" * rng.randrange(3)) for i in range(rng.randrange(4))]
        turns += [(c, *t[1:]) for t in shared] + own
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    tree, runs, members = chat_tree.build(df)
    nodes, spans = chat_tree.tokens(tree, runs, "byte_bpe_50k.json", blanks=True)
    tok = library_tokenizer(tokenizer_path("byte_bpe_50k.json"))
    stream, positions, taught = {}, {}, set()
    for r in nodes.collect():
        for k, (i, p) in enumerate(zip(r["ids"], r["position_ids"], strict=True)):
            assert r["stream_start"] + k not in stream
            stream[r["stream_start"] + k], positions[r["stream_start"] + k] = i, p
        taught |= set(range(r["loss_start"], r["loss_end"])) if r["loss_start"] is not None else set()
    assert sorted(stream) == list(range(len(stream)))
    attends = {r["leaf"]: r["attends"] for r in spans.collect()}
    for m in members.collect():
        at = [k for x in attends[m["leaf"]] for k in range(x["start"], x["end"])]
        want, mask = [], []
        for _, _, role, text in [t for t in turns if t[0] == m["conv_id"]]:
            for part, loss in ((f"<|im_start|>{role}<|im_sep|>", False), (text, role == "assistant"), ("<|im_end|>", False)):
                ids = tok.encode(part, add_special_tokens=False).ids
                want += ids
                mask += [loss] * len(ids)
        assert [stream[k] for k in at] == want and [positions[k] for k in at] == list(range(len(want))) and [k in taught for k in at] == mask


def test_url_parts_and_rules(spark):
    urls = ["http://A.Example.COM/en/7x?q", "https://example.net/de/81", "//x/y", None, "", "ftp://host", "http://h?x/#/en", "x://b.org/es/#", "a://b://c/d", "http://notcom/en/"]
    pages = spark.createDataFrame([(i, u, "<p>") for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, rule string")
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    rows = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge(pages, labels, URL_RULES).collect()}
    none = ("", "", None, "allow")
    assert rows == {
        0: ("a.example.com", "/en/7x", "example.com/en/7", "allow"), 10: ("a.example.com", "/en/7x", "example.com/en/7", "allow"), 1: ("example.net", "/de/81", "example.net/de/8", "block"),
        2: none, 3: none, 4: none, 5: ("host", "", None, "allow"), 6: ("h", "", None, "allow"), 7: ("b.org", "/es/", "org/es/", "block"), 8: ("b:", "//c/d", None, "allow"), 9: ("notcom", "/en/", None, "allow"),
    }
    assert url_rules.judge(pages.limit(0), labels, URL_RULES).count() == 0


def test_url_mining(spark):
    rng = random.Random(6)
    rows = [(i, f"http://{'cheap-pills' if i % 4 == 0 else 'news'}.site{rng.randrange(9)}.net/{'read' if i % 4 == 3 else 'buy'}/{i}", i % 4 == 0) for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    rules = url_rules.mine(pages.select("page_id", "url"), pages.select("page_id", "bad"))
    assert rules.where("array_contains(tokens, 'word:pills')").count() >= 1
    fired = {r["page_id"] for r in url_rules.fired(pages, rules).collect()}
    assert fired == {i for i, _, bad in rows if bad}


def test_url_mining_keeps_the_weaker_word(spark):
    kinds = [("strong", 100, 100), ("weak", 100, 70), ("plain", 800, 0)]
    rows = [(f"http://{word}.site.net/a/b/c/d/e/f/g/h", i < bad) for word, n, bad in kinds for i in range(n)]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, bad boolean")
    rules = url_rules.mine(pages.select("page_id", "url"), pages.select("page_id", "bad"))
    found = {(*r["tokens"], round(r["confidence"], 2), r["pages"]) for r in rules.collect()}
    assert found == {(mark + word, share, n) for mark in ("host:", "word:") for word, share, n in (("strong", 1.0, 100), ("weak", 0.7, 70))}
    assert {r["page_id"] for r in url_rules.fired(pages, rules).collect()} == set(range(200))


def test_url_mining_against_all_combinations(spark):
    rng = random.Random(9)
    urls = ["x://" + "/".join(["h", *(t for t in "abcde" if rng.random() < 0.6)]) for _ in range(400)]
    bad = [rng.random() < (0.8 if "/a" in u and "/b" not in u else 0.7 if "/c/d" in u else 0.3) for u in urls]
    pages = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(zip(urls, bad))], "page_id long, url string, bad boolean")
    rules = url_rules.mine(pages.select("page_id", "url"), pages.select("page_id", "bad"))
    sets = [{"host:h", "word:h", "scheme:x", *(f"path:{t}" for t in u.split("/")[3:])} for u in urls]
    every = sorted(set().union(*sets))
    raw = {}
    for k in range(1, len(every) + 1):
        for own in map(frozenset, itertools.combinations(every, k)):
            marks = [b for x, b in zip(sets, bad) if own <= x]
            if sum(marks) >= url_rules.SUPPORT and sum(marks) / len(marks) >= url_rules.CONFIDENCE:
                raw[own] = sum(marks) / len(marks)
    best = {own: c for own, c in raw.items() if not any(k < own and raw[k] >= c for k in raw)}
    assert len(best) > 3 and {frozenset(r["tokens"]): r["confidence"] for r in rules.collect()} == best


def test_embeddings(spark):
    rng = np.random.default_rng(7)
    base = rng.standard_normal((60, 16))
    x = np.concatenate([base, base[:40] + 0.05 * rng.standard_normal((40, 16)), base[:5]]).astype(np.float32)
    rows = [(i, [float(v) for v in e], int(i % 60) % 3) for i, e in enumerate(x)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    rows += [(1000 + i, e, 0) for i, e in enumerate(odd)] + [(2000, rows[0][1], None), (2001, rows[0][1], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in embedding_forest.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    u = x / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    label = np.array([r[2] for r in rows[: len(x)]])
    near = (u @ u.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    assert [got[i]["n_links"] for i in range(len(x))] == near.sum(1).tolist()
    assert all(got[i]["kept"] and got[i]["n_links"] == 0 for i in [*range(1000, 1006), 2000, 2001])
    component = list(range(len(x)))
    for _ in x:  # smallest reachable, by waves
        component = [min([component[i], *(component[j] for j in np.flatnonzero(near[i]))]) for i in range(len(x))]
    assert [got[i]["component_id"] for i in range(len(x))] == component
    assert embedding_forest.near_duplicates(df.limit(0)).count() == 0


def test_forest_recall_when_trees_split(spark, monkeypatch):
    monkeypatch.setattr(embedding_forest, "LEAF", 60)
    monkeypatch.setattr(embedding_forest, "BLOCK", 50)
    rng = np.random.default_rng(8)
    base = rng.standard_normal((200, 32))
    x = np.concatenate([base, base + 0.1 * rng.standard_normal(base.shape), base + 0.1 * rng.standard_normal(base.shape)])
    df = spark.createDataFrame([(i, e.tolist(), 0) for i, e in enumerate(x)], "vec_id long, embedding array<double>, label int")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = (u @ u.T >= 0.93).sum() - len(x)
    found = embedding_forest.near_duplicates(df).agg(F.sum("n_links")).first()[0]
    assert 0.9 * true <= found <= true


def test_large_leaves_are_cut_level_by_level(spark, monkeypatch):
    """With a sample too small to split anything, all cuts are made on all points; links stay."""
    monkeypatch.setattr(embedding_forest, "SAMPLE", 10)
    monkeypatch.setattr(embedding_forest, "BLOCK", 150)
    rng = np.random.default_rng(12)
    base = rng.standard_normal((400, 32))
    x = np.concatenate([base, base + 0.1 * rng.standard_normal(base.shape), base[:1] + 0.05 * rng.standard_normal((200, 32))])
    df = spark.createDataFrame([(i, e.tolist(), 0) for i, e in enumerate(x)], "vec_id long, embedding array<double>, label int")
    _, distinct = embedding_forest.points(df)
    known = embedding_forest.stage(distinct, "vectors")
    forest = embedding_forest.fit(known)
    assert all(t is None for t in forest["0|32"])
    placed = embedding_forest.cut_large(known, embedding_forest.stage(embedding_forest.route(known, forest), "leaves"))
    sizes = [r["count"] for r in placed.groupBy("leaf").count().collect()]
    assert len(sizes) > 8 * 4 and placed.select("point").distinct().count() == 1000
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = (u @ u.T >= 0.93).sum(1) - 1
    found = {r["vec_id"]: r["n_links"] for r in embedding_forest.near_duplicates(df).collect()}
    found = np.array([found[i] for i in range(len(x))])
    assert (found <= true).all() and found.sum() >= 0.9 * true.sum() and found[:800].sum() >= 0.9 * true[:800].sum()


def test_every_query_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


