"""Toxicity by a weighted finite-state pattern grammar over clauses.

A first transducer reads letters and writes words with a class and a weight:
learned abuse (whole words and word beginnings that labelled toxic documents
hold far more often than others), target, menace, negation, report, quotation
mark or clause end.  Five small machines run over the classes: INSULT notes
abuse, TARGET whom it is aimed at, MENACE a threat, NEGATION whether all abuse of a
clause is denied, REPORT reporting words and quotations, which may span clauses.
``compose`` makes one transducer of them whose states are tuples of theirs; at
the end of a clause it writes the clause's reading (plain, aimed, threat,
negated or reported) with the weight of its strongest abuse.

A last machine adds the weights of a document's clauses, nested by reading:
those of all, of all that are meant, of the aimed among them, of the threats among
those.  A logistic map with no negative weight, fitted to labels, gives the score.
So a threat never counts less than an aimed insult, that never less than a plain
one, and a denied or reported one never more; how much is learned.

Only labels of the training rows and texts are read; ``labels``, language,
source and doc_id are no inputs of a score.  At most ``max_train`` labelled
documents are used, those with the smallest hash of their doc_id.  Null text
counts as empty.  Where no abuse could be learned all texts get 0: the labels' base
rate tells no text from another, and could be over the threshold for all.  Equal texts score alike
whatever their doc_id.  A doc_id that several rows have is learned from once, by its
smallest text, and counts as toxic if one of its labels does; a null doc_id has no
label and is not held out.  Labels of documents that don't exist are left out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents a fit uses at most.
MAX_TRAIN = 8_000
#: Lengths of word beginnings that are features beside whole words.
BEGINNINGS = (5, 6, 7, 8)
#: Least log-likelihood ratio of a feature with the label, and least documents.
SIGNIFICANT, LEAST = 18.0, 4
THRESHOLD = 0.3
#: Distinct words a task remembers the class of.
MAX_WORDS = 150_000

TARGET = frozenset("you your yours he him his she her they them their u du dich dir ihr euch sie er tu te toi vous votre il elle ils tú ti usted ustedes él ella ellos".split())
NEGATION = frozenset("not no never isn't aren't don't nobody nicht kein keine nie niemals ne pas jamais aucun nunca jamás ni".split())
REPORT = frozenset("said says say called calls call claimed reported wrote quoted sagte sagt nannte dit disait appelé dijo dice llamó".split())
MENACE = frozenset("kill hurt hit beat burn shoot destroy die töten schlagen sterben tuer frapper mourir matar golpear morir".split())
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?;:\n]|[\"“”«»]")

# classes of words
OTHER, END, QUOTE, AIM, NOT, SAID, THREAT, ABUSE = range(8)
READINGS = ("plain", "aimed", "threat", "negated", "reported")
#: Sums over clauses, each a part of the one before: which readings count.
NESTED = {"all": READINGS, "meant": ("plain", "aimed", "threat"), "at_someone": ("aimed", "threat"), "threatened": ("threat",)}
#: What the logistic map reads.
INPUTS = ("one", "largest", *NESTED, "clauses", "share")
#: Arcs (state, class) -> state of the five machines; any other class leaves a state.
INSULT = {("", ABUSE): "insult", ("insult", END): ""}
TARGETED = {("", AIM): "aimed", ("aimed", END): ""}
MENACED = {("", THREAT): "menace", ("menace", END): ""}
NEGATED = {("", NOT): "not", ("", ABUSE): "meant", ("not", ABUSE): "denied", ("not", END): "", ("meant", END): "", ("denied", END): ""}
REPORTED = {("", SAID): "said", ("", QUOTE): "quoted", ("said", QUOTE): "quoted", ("quoted", QUOTE): "said", ("said", END): ""}


def reading(insult: str, target: str, menace: str, negation: str, report: str) -> int | None:
    """What a clause that ends in these states is read as."""
    if not insult:
        return None
    if report:
        return 4
    if negation == "denied":
        return 3
    return (2 if menace else 1) if target else 0


def compose(*machines: dict[tuple[str, int], str]) -> tuple[list[list[int]], list[int | None]]:
    """One transducer of several that read the same classes: next state by state and class, and the reading a clause end writes in a state.
    Only states that can be reached are made; all machines start in ""."""
    number = {("",) * len(machines): 0}
    steps: list[list[int]] = []
    for state in (order := list(number)):  # grows while it is read
        steps.append([])
        for kind in range(8):
            after = tuple(m.get((s, kind), s) for m, s in zip(machines, state))
            if after not in number:
                number[after] = len(number)
                order.append(after)
            steps[-1].append(number[after])
    return steps, [reading(*s) for s in order]


STEPS, WRITES = compose(INSULT, TARGETED, MENACED, NEGATED, REPORTED)


@dataclass
class Model:
    """Weights of abusive features, and the logistic map over INPUTS."""

    abuse: dict[str, float] = field(default_factory=dict)
    map: list[float] = field(default_factory=lambda: [0.0] * len(INPUTS))


def features_of(word: str) -> list[str]:
    return [word, *[f"{word[:n]}*" for n in BEGINNINGS if len(word) > n]]


class _Classes(dict):
    """The first transducer: class and weight of a word, remembered."""

    def __init__(self, abuse: dict[str, float]):
        super().__init__()
        self.abuse = abuse

    def __missing__(self, word: str) -> tuple[int, float]:
        found = [self.abuse[f] for f in features_of(word) if f in self.abuse] if word[0].isalpha() else []
        if found:
            out = (ABUSE, max(found))
        elif not word[0].isalpha():
            out = (QUOTE if word in "\"“”«»" else END, 0.0)
        else:
            out = (next((c for c, own in ((AIM, TARGET), (NOT, NEGATION), (SAID, REPORT), (THREAT, MENACE)) if word in own), OTHER), 0.0)
        if len(self) < MAX_WORDS:
            self[word] = out
        return out


def clauses(classes: list[tuple[int, float]]) -> Iterator[tuple[int, float]]:
    """The composed transducer: the reading and the weight of every clause that holds abuse."""
    state, weight = 0, 0.0
    for kind, w in [*classes, (END, 0.0)]:
        if kind == OTHER:
            continue
        if kind == END:
            if weight:
                yield WRITES[state], weight
            weight = 0.0
        elif w > weight:
            weight = w
        state = STEPS[state][kind]


def inputs(text: str | None, known: _Classes) -> list[float]:
    """The last machine's sums."""
    classes = list(map(known.__getitem__, _TOKEN.findall((text or "").lower())))
    by, largest, n = [0.0] * len(READINGS), 0.0, 0
    if any(c[0] == ABUSE for c in classes):
        for r, w in clauses(classes):
            by[r] += w
            n += r < 3
            if r < 3:
                largest = max(largest, w)
    sums = [sum(by[READINGS.index(r)] for r in own) for own in NESTED.values()]
    return [1.0, largest, *map(math.log1p, sums), math.log1p(n), sums[1] / math.sqrt(len(classes) + 20.0)]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """text, toxic and fold of the labelled documents that a fit uses: ``max_train`` rows at most, however often a doc_id repeats."""
    some = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_train)  # the documented bound of the sample
    )
    fold = (F.xxhash64(F.col("doc_id"), F.lit("fold")) % 2).cast("int")
    found = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return found.select("text", F.col("toxic").cast("int").alias("toxic"), F.abs(fold).alias("fold"))


def _weights(counts: dict[str, tuple[float, float]], toxic: float, clean: float) -> dict[str, float]:
    """Log-odds of the features that go with the label significantly."""
    out = {}
    if not toxic or not clean:
        return out
    rate = toxic / (toxic + clean)
    for f, (t, n) in counts.items():
        here = t / (t + n)
        if t < LEAST or here <= rate:
            continue
        ratio = 2 * (t * math.log(here / rate) + (n * math.log((1 - here) / (1 - rate)) if n else 0.0))
        if ratio >= SIGNIFICANT:
            out[f] = math.log((t + 0.5) / (toxic + 1)) - math.log((n + 0.5) / (clean + 1))
    return {f: w for f, w in out.items() if w > 0.7}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic map, none below 0 but the first; inputs that would need that are left out one by one."""
    use = list(range(x.shape[1]))
    while True:
        own, b = x[:, use], np.zeros(len(use))
        keep = np.full(len(b), ridge)
        keep[0] = 1e-3
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(own @ b, -30, 30)))
            step = np.linalg.solve((own * (p * (1 - p))[:, None]).T @ own + np.diag(keep), own.T @ (y - p) - keep * b)
            b += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-6:
                break
        if (b[1:] >= 0).all():
            out = np.zeros(x.shape[1])
            out[use] = b
            return out
        use.pop(1 + int(np.argmin(b[1:])))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Learns features on both folds, and the map on each fold with the other fold's features."""
    rows = training_rows(docs, labels, max_train).persist()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for text, toxic, fold in zip(*(c.to_pylist() for c in b.columns), strict=True):
                seen[("", fold, toxic)] += 1
                words = {w for w in _TOKEN.findall((text or "").lower()) if w[0].isalpha()}
                seen.update((f, fold, toxic) for f in {f for w in words for f in features_of(w)})
        key = list(seen)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in key], pa.string()), pa.array([2 * k[1] + (k[2] > 0) for k in key], pa.int32()), pa.array(list(seen.values()), pa.int64())], ["f", "part", "n"])

    counted = rows.mapInArrow(count, "f string, part int, n long").groupBy("f").agg(*[F.sum(F.when(F.col("part") == p, F.col("n")).otherwise(0)).alias(f"n{p}") for p in range(4)])
    # features seen in LEAST toxic training documents: bounded with the sample
    found = {r[0]: r[1:] for r in counted.where((F.col("f") == "") | (F.col("n1") + F.col("n3") >= LEAST)).collect()}
    all_of = found.pop("", (0, 0, 0, 0))
    toxic, clean = all_of[1] + all_of[3], all_of[0] + all_of[2]
    out = Model()
    out.abuse = _weights({f: (n[1] + n[3], n[0] + n[2]) for f, n in found.items()}, toxic, clean)
    halves = [_weights({f: (n[1], n[0]) for f, n in found.items() if n[1]}, all_of[1], all_of[0]), _weights({f: (n[3], n[2]) for f, n in found.items() if n[3]}, all_of[3], all_of[2])]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [_Classes(h) for h in halves]
        for b in batches:
            x = [inputs(t, known[1 - fold]) for t, _, fold in zip(*(c.to_pylist() for c in b.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1)], ["x", "toxic"])

    if toxic and clean:
        sample = rows.mapInArrow(read, "x array<double>, toxic int").collect()  # max_train rows at most
        out.map = _logistic(np.array([r[0] for r in sample]), np.array([float(r[1] > 0) for r in sample])).tolist()
    rows.unpersist()
    return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with a column ``toxicity``, 0 to 1; an input column of that name gives way to it."""
    docs = docs.drop("toxicity")
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights = _Classes(model.abuse), np.array(model.map)
        for b in batches:
            if model.abuse:
                x = np.array([inputs(t, known) for t in b.column(at).to_pylist()]).reshape(-1, len(INPUTS))
                s = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            else:
                s = np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], [*b.schema.names, "toxicity"])

    return docs.mapInArrow(run, ", ".join([*kinds, "toxicity double"]))
