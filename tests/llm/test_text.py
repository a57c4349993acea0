"""Line dedup, near copies, decontamination, toxicity and the pipeline."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerly.llm import decontaminate, jaccard, line_dedup, toxicity


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")


def sentence(rng, n=9):
    return " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n)) + "."


def test_line_dedup(spark, odd, none):
    rng = random.Random(1)
    run = " ".join(sentence(rng) for _ in range(7))  # over 50 words
    texts = [sentence(rng) + " " + run + " " + sentence(rng), "x " + sentence(rng) + " " + run + "\n" + sentence(rng), sentence(rng), run]
    out = {r["doc_id"]: r for r in line_dedup.dedup(docs_of(spark, texts)).collect()}
    assert out[0]["text"] == texts[0] and out[2]["text"] == texts[2]
    assert out[3]["text"] == "" and out[3]["left"] == 0
    assert run[:200] not in out[1]["text"] and texts[1].split("\n")[1] in out[1]["text"]
    marked = line_dedup.dedup(docs_of(spark, ["a b.\x01 c d. e", "a\nb. c"])).select("text", "n_lines").collect()
    assert [tuple(r) for r in marked] == [("a b.\x01 c d. e", 2), ("a\nb. c", 3)]
    kept = line_dedup.dedup(odd.withColumns({"gone": F.lit("x"), "left": F.lit(1), "n_lines": F.lit("y"), "_gone": F.lit(2)}))
    assert sorted(map(str, kept.select(*odd.columns).collect())) == sorted(map(str, odd.collect())) and kept.where("left < 1").count() == 0
    assert line_dedup.dedup(none).count() == 0


def test_jaccard_against_all_pairs(spark, odd, none):
    rng = random.Random(2)
    texts = []
    for _ in range(12):
        base = sentence(rng, 60).split()
        for edits in (0, 1, 1, 2, 3, 6):
            words = list(base)
            for _ in range(edits):
                words[rng.randrange(len(words))] = "".join(rng.choices("xyz", k=7))
            texts.append(" ".join(words))
    texts += ["", None, "a b", "a b", "A B"]

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()

    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    rows = jaccard.groups(docs_of(spark, texts), words=4, percent=85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == {i: (len(s), root(i)) for i, s in enumerate(sets)}
    assert jaccard.groups(odd).count() == odd.count() and jaccard.groups(none).count() == 0
    assert set(jaccard.dedup(odd).columns) == set(odd.columns)


def test_large_cells_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_POINTS", 6)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 400)
    rng = random.Random(3)
    base = sentence(rng, 120).split()
    texts = [" ".join(base[:i] + ["z" * (i % 5 + 3)] + base[i + 1 :]) for i in range(40)]
    rows = jaccard.groups(docs_of(spark, texts), words=4, percent=85).collect()
    assert {r["component_id"] for r in rows} == {0}


def components_of(texts, words, percent):
    """The smallest index reachable by links, by all pairs."""
    w = [t.lower().split() for t in texts]
    sets = [{tuple(x[i : i + words]) for i in range(len(x) - words + 1)} for x in w]
    out = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= percent * len(a | b) and out[i] != out[j]:
                low, high = sorted((out[i], out[j]))
                out = [low if x == high else x for x in out]
    return out


@pytest.mark.parametrize(("block", "pivots", "shrunk"), [(10, 4, 0.6), (10, 2, 0.9), (16, 3, 0.0)])
def test_regions_recur_exactly(spark, monkeypatch, block, pivots, shrunk):
    """One large region of many components at the edge of the threshold: pivots, windows and blocks lose no link."""
    monkeypatch.setattr(jaccard, "BLOCK_POINTS", block)
    monkeypatch.setattr(jaccard, "PIVOTS", pivots)
    monkeypatch.setattr(jaccard, "SHRUNK", shrunk)
    rng = random.Random(block + pivots)
    base = sentence(rng, 160).split()
    texts = []
    for _ in range(14):  # families that share most of the base, and are barely linked or not
        family = list(base)
        at = rng.randrange(40, 100)
        family[at : at + 22] = sentence(rng, 22).split()
        for _ in range(8):
            own = list(family)
            at, n = rng.randrange(110, 140), rng.randrange(0, 12)
            own[at : at + n] = sentence(rng, n).split()
            texts.append(" ".join(own))
    rows = jaccard.groups(docs_of(spark, texts), words=4, percent=80).collect()
    want = components_of(texts, 4, 80)
    assert 1 < len(set(want)) < len(texts)
    assert [r["component_id"] for r in sorted(rows, key=lambda r: r["doc_id"])] == want


def distance(pattern, text):
    """Least edits of the pattern to any substring, by the whole matrix."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != x), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


@given(st.text("ab ", min_size=1, max_size=90), st.text("ab ", max_size=120))
@settings(max_examples=200, deadline=None)
def test_myers(pattern, text):
    assert decontaminate.Myers(pattern).best(text)[0] == distance(pattern, text)


@given(st.text("abcdefgh ", min_size=30, max_size=60), st.lists(st.tuples(st.integers(0, 59), st.sampled_from("xyz")), max_size=8), st.text("abcdefgh ", max_size=30))
@settings(max_examples=200, deadline=None)
def test_pigeonhole_finds_all(item, edits, around):
    item = decontaminate.normal(item)
    if len(item) < decontaminate.MIN_CHARS:
        return
    changed = list(item)
    for at, c in edits:
        changed[at % len(changed)] = c
    text = around + "".join(changed) + around
    k, d = decontaminate.budget(len(item)), distance(item, text)
    found = decontaminate.Matcher([(1, item)]).find(text)
    assert [h[1] for h in found] == ([d] if d <= k else [])


def test_decontamination(spark, odd, none):
    items = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog near the river bank."), (2, None), (3, "dog"), (4, "")], "item_id long, text string")
    docs = docs_of(spark, ["Well: the QUICK brown fox, jumps over the lazi dog near the river bank! ok", "nothing to see", None, ""])
    assert [(r["doc_id"], r["item_id"], r["distance"]) for r in decontaminate.matches(docs, items).collect()] == [(0, 1, 1)]
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, items).collect()) == [1, 2, 3]
    assert decontaminate.clean(odd, items).count() == odd.count() and decontaminate.matches(none, items).count() == 0
    assert decontaminate.matches(docs, items.limit(0)).count() == 0


def test_short_items_match_word_for_word(spark):
    items = spark.createDataFrame([(1, "Tiger"), (2, "a b"), (3, "x"), (4, " -- "), (5, None), (6, "日本 語"), (7, "tiger")], "item_id long, text string")
    docs = docs_of(spark, ["The tiger, a B!", "tigers and atiger ab", "x", "日本、語", None, "a-b tiger tiger"])
    rows = {(r["doc_id"], r["item_id"], r["start"], r["end"], r["distance"]) for r in decontaminate.matches(docs, items, shortest=1).collect()}
    assert rows == {(0, 1, 4, 9, 0), (0, 7, 4, 9, 0), (0, 2, 10, 13, 0), (2, 3, 0, 1, 0), (3, 6, 0, 4, 0), (5, 2, 0, 3, 0), (5, 1, 4, 9, 0), (5, 7, 4, 9, 0)}
    assert [r["doc_id"] for r in decontaminate.clean(docs, items, shortest=1).orderBy("doc_id").collect()] == [1, 4]


def toxic_docs(spark, n=240):
    rng = random.Random(4)
    texts = [sentence(rng) + (" you are a grobnak and a fleebor. " if i % 3 == 0 else " fine weather. ") + sentence(rng) for i in range(n)]
    docs = docs_of(spark, texts)
    return docs, spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(n)] + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")


def test_toxicity(spark, odd, none):
    docs, labels = toxic_docs(spark)
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert all((r["toxicity"] >= 0.3) == (r["doc_id"] % 3 == 0) for r in rows)
    assert toxicity.score(odd, model).where("toxicity IS NULL OR toxicity < 0 OR toxicity > 1").count() == 0
    again = toxicity.score(docs.withColumn("toxicity", F.lit("own")), model)
    assert again.columns.count("toxicity") == 1 and [r["toxicity"] for r in again.collect()] == [r["toxicity"] for r in rows]
    assert odd.where(toxicity.held_out(F.col("doc_id")).isNull()).count() == 0
    # one row for each labelled doc_id, however often it repeats
    twice = docs.unionByName(docs).unionByName(docs.withColumn("text", F.concat("text", F.lit("z"))))
    assert sorted(toxicity.training_rows(twice, labels).collect()) == sorted(toxicity.training_rows(docs, labels).collect())
    nothing = toxicity.fit(none, labels.limit(0))
    assert [r["toxicity"] for r in toxicity.score(odd.limit(2), nothing).collect()] == [0.0, 0.0] and toxicity.score(none, model).count() == 0


def test_readings():
    c = {"you": (toxicity.AIM, 0.0), "not": (toxicity.NOT, 0.0), "said": (toxicity.SAID, 0.0), "fool": (toxicity.ABUSE, 2.0), ".": (toxicity.END, 0.0), "kill": (toxicity.THREAT, 0.0), '"': (toxicity.QUOTE, 0.0)}
    read = lambda s: [(toxicity.READINGS[r], w) for r, w in toxicity.clauses([c.get(w, (toxicity.OTHER, 0.0)) for w in s.split()])]
    assert read("a fool . you fool . not a fool . he said fool . kill you fool") == [("plain", 2.0), ("aimed", 2.0), ("negated", 2.0), ("reported", 2.0), ("threat", 2.0)]
    assert read('" fool . fool " fool') == [("reported", 2.0), ("reported", 2.0)]


def by_flags(classes):
    """The readings by plain flags, clause by clause."""
    out, quoted, clause = [], False, []
    for kind, w in [*classes, (toxicity.END, 0.0)]:
        if kind != toxicity.END:
            clause.append((kind, w))
            continue
        reported = quoted or any(k in (toxicity.SAID, toxicity.QUOTE) for k, _ in clause)
        kinds = [k for k, _ in clause]
        if toxicity.ABUSE in kinds:
            denied = toxicity.NOT in kinds[: kinds.index(toxicity.ABUSE)]
            aimed = toxicity.AIM in kinds
            name = "reported" if reported else "negated" if denied else ("threat" if toxicity.THREAT in kinds else "aimed") if aimed else "plain"
            out.append((name, max(w for k, w in clause if k == toxicity.ABUSE)))
        quoted ^= kinds.count(toxicity.QUOTE) % 2 == 1
        clause = []
    return out


@given(st.lists(st.tuples(st.integers(0, 7), st.floats(0.8, 9.0))))
@settings(max_examples=500, deadline=None)
def test_composed_transducer_against_flags(classes):
    classes = [(k, w if k == toxicity.ABUSE else 0.0) for k, w in classes]
    assert [(toxicity.READINGS[r], w) for r, w in toxicity.clauses(classes)] == by_flags(classes)


def test_readings_are_ordered(spark):
    """A threat scores at least as an aimed insult, that as a plain one, and denied or reported ones below."""
    rng = random.Random(10)
    frame = ["it is a {} here today.", "you are a {} here today.", "you {} i will kill you.", "this is not a {} here.", 'he said "{}" again.']  # equally long
    rows = [(k % 5, k % 2, " ".join([sentence(rng, 12), frame[k % 5].format("grobnak" if k % 2 else "flower"), sentence(rng, 12)])) for k in range(1000)]
    docs = docs_of(spark, [t for _, _, t in rows])
    labels = spark.createDataFrame([(i, 1, int(bad and form < 3)) for i, (form, bad, _) in enumerate(rows)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    assert "grobnak" in model.abuse and all(w >= 0 for w in model.map[1:])
    probes = docs_of(spark, ["one two three. " + f.format("grobnak") for f in frame])
    plain, aimed, threat, denied, told = [r["toxicity"] for r in toxicity.score(probes, model).orderBy("doc_id").collect()]
    assert threat >= aimed >= plain >= 0.5 > max(denied, told)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(5)
    at = f"file://{tmp_path_factory.mktemp('sf')}"
    item = sentence(rng, 30)
    docs, labels = toxic_docs(spark, 120)
    rows = [tuple(r) for r in docs.collect()]
    clean = [sentence(rng, 30) for _ in range(5)]
    for t in [*clean, clean[0], "so: " + item + " done", sentence(rng, 20) + " you grobnak fleebor grobnak. " + sentence(rng)]:
        rows.append((len(rows), t, "en", "s", len(t)))
    spark.createDataFrame(rows, docs.schema).write.parquet(f"{at}/documents.parquet")
    labels.write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def test_pipeline(spark, corpus):
    out = corpus_pipeline.run(spark, corpus).collect()
    assert {r["doc_id"] for r in out} == {i for i in range(120) if i % 3} | set(range(120, 125))
    assert all(len(r["ids"]) == r["length"] for r in out)


@pytest.mark.parametrize(("name", "work"), corpus_pipeline.STAGES)
def test_stages_with_odd_rows(spark, corpus, odd, none, name, work):
    """Null, empty, blank, tied and very long rows, names that clash with the operators' own, and no rows at all."""
    clash = ("toxicity", "gone", "left", "n_lines", "_first", "class", "_doc", "h", "kept", "d", "score", "ids", "c0")

    def more(docs):
        return docs.select("*", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in clash if c not in docs.columns])

    docs = more(odd)
    out = work(spark, docs, corpus)
    rows = sorted(map(str, docs.collect()))
    if name == "best_fit_packing":
        assert out.where("piece = 0").count() == len(rows) and work(spark, more(none), corpus).count() == 0
        return
    assert out.columns == docs.columns and work(spark, more(none), corpus).count() == 0
    # of the near copies the second goes, of equal rows of one doc_id both stay
    copies = {str(r) for r in docs.collect() if r["doc_id"] == 6} if name == "ngram_jaccard_join" else set()
    assert sorted(map(str, out.collect())) == [r for r in rows if r not in copies]


def test_own_text_beside_a_shared_passage_survives(spark):
    rng = random.Random(6)
    passage, own = [" ".join(sentence(rng) for _ in range(n)) for n in (9, 3)]
    docs = docs_of(spark, [sentence(rng) + "\n" + passage, passage + "\n" + own, passage])
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.drop_repeated_lines(spark, docs, "").collect()}
    assert out == {0: (docs.first()["text"], len(docs.first()["text"])), 1: (own, len(own))}


def by_brute_force(texts, run=8):
    """The lines to delete: in a run of ``run`` words or more that stood earlier; blank ones go with the line before."""
    seen, gone = set(), {}
    for d, text in enumerate(texts):
        cut = [s.strip(" \n") for s in re.split(r"(?<=\n)|(?<=[.!?;] )", text)]
        full = [i for i, s in enumerate(cut) if s]
        own = set()
        for x in range(len(full)):
            for y in range(x + 1, len(full) + 1):
                key = tuple(cut[i] for i in full[x:y])
                if sum(len(s.split(" ")) for s in key) >= run:
                    if key in seen:
                        own |= set(range(full[x] if x else 0, full[y] if y < len(full) else len(cut)))
                    seen.add(key)
        gone[d] = sorted(own) or None
    return gone


def gone_of(spark, texts):
    return {r["doc_id"]: r["gone"] for r in line_dedup.dedup(docs_of(spark, texts)).collect()}


@pytest.mark.parametrize("words", [8, 9, 10, 11, 12])
def test_single_lines_beside_other_neighbours(spark, words):
    rng = random.Random(words)
    lines = [sentence(rng, words) for _ in range(6)]
    texts = [sentence(rng, 20) + "\n" + lines[i % 6] + "\n" + sentence(rng, 20) for i in range(60)]
    gone = gone_of(spark, texts)
    assert gone == by_brute_force(texts) and sum(g == [1] for g in gone.values()) == 54


def test_passages_around_a_frequent_line(spark):
    rng = random.Random(7)
    often, a, b = [sentence(rng, n) for n in (9, 5, 6)]
    texts = [sentence(rng, 20) + "\n" + often + "\n" + sentence(rng, 20)]
    texts += [sentence(rng, 20) + "\n" + "\n".join([a, often, b]) + "\n" + sentence(rng, 20) for _ in range(4)]
    gone = gone_of(spark, texts)
    assert gone == by_brute_force(texts) and [gone[i] for i in (1, 2, 3, 4)] == [[2], *[[1, 2, 3]] * 3]


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(8)
    pool = [sentence(rng, n) for n in (1, 1, 2, 3, 4, 5, 7, 8, 9, 13)] + ["", " "]
    texts = ["".join(rng.choice(pool) + rng.choice("\n ") for _ in range(rng.randrange(1, 14))) for _ in range(150)]
    assert gone_of(spark, texts) == by_brute_force(texts)


def test_pipeline_drops_what_op10_predicts(spark, monkeypatch):
    docs = docs_of(spark, ["a", "b", "c"])
    score = F.when(F.col("doc_id") == 0, 0.29).when(F.col("doc_id") == 1, toxicity.THRESHOLD).otherwise(0.49)
    monkeypatch.setattr(toxicity, "fit", lambda docs, labels: None)
    monkeypatch.setattr(toxicity, "score", lambda docs, model: docs.withColumn("toxicity", score))
    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: None)
    assert [r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, "").collect()] == [0]
