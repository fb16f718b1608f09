"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, reported speech). Small transducers, one per pattern, are
composed into one table that walks a sentence and weighs each insult or threat by what stands around it; a matched
clause counts, not the word alone. Insults are seeded by a list and completed by words and stems that labels give away.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm.batches import map_batches, raw

# Seed words by class, in English, German, French and Spanish.
SEEDS = {
    "insult": "idiot idiots moron morons stupid loser losers scum trash pathetic worthless disgusting clown dumb fool jerk freak filth vermin imbecile "
    "dumm blöd idiotin trottel abschaum versager widerlich crétin imbécile abruti débile salaud minable tonto estúpido imbécil idiota asqueroso basura",
    "threat": "kill hurt destroy shoot stab beat strangle töten umbringen verprügeln tuer frapper détruire matar golpear destruir",
    "target": "you your yours u ur he she they them him her these those everyone du dich dir ihr euch tu toi vous eux tú ti usted ustedes ellos",
    "negation": "not no never nor don't isn't aren't won't can't nicht kein keine nie ne pas jamais aucun nunca jamás ningún",
    "report": "said says told called claims claimed wrote quoted reported allegedly sagte nannte behauptet dit appelé prétend dijo llamó afirma",
}
SYMBOLS = ("other", "insult", "threat", "target", "negation", "report")
#: Labelled documents that the lexicon and the weights are fitted on, at most about this many, chosen by a hash of their id.
FIT_ROWS = 20_000
STEMS = (5, 6, 7)
LEAST_DOCS = 4
LEAST_ODDS = 1.2
THRESHOLD = 0.3
TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)?|[.!?\n]|[,;:]")
_CACHE = 400_000
_FEATURES = 4


@dataclass(frozen=True)
class Transducer:
    """A finite-state weigher: ``step(state, symbol)`` gives the next state and the factor for a symbol read there."""

    states: int
    step: object


def countdown(opener: int, reach: int, factor: float, on: tuple[int, ...]) -> Transducer:
    """After ``opener`` and for ``reach`` more words, symbols in ``on`` are weighed by ``factor``."""

    def step(state: int, symbol: int) -> tuple[int, float]:
        weight = factor if state and symbol in on else 1.0
        return (reach if symbol == opener else max(0, state - 1)), weight

    return Transducer(reach + 1, step)


def lasting(opener: int, factor: float, on: tuple[int, ...]) -> Transducer:
    """After ``opener`` and up to the end of the sentence, symbols in ``on`` are weighed by ``factor``."""

    def step(state: int, symbol: int) -> tuple[int, float]:
        return int(state or symbol == opener), factor if state and symbol in on else 1.0

    return Transducer(2, step)


def compose(machines: list[Transducer], symbols: int = len(SYMBOLS)) -> tuple[list[list[int]], list[list[float]]]:
    """One table for several transducers in a row: next state and product of factors by state and symbol. State 0 is the start."""
    numbers, todo, nexts, weights = {(0,) * len(machines): 0}, [(0,) * len(machines)], [], []
    while len(nexts) < len(todo):
        state = todo[len(nexts)]
        row_next, row_weight = [], []
        for symbol in range(symbols):
            moved = [m.step(s, symbol) for m, s in zip(machines, state)]
            goal, weight = tuple(x[0] for x in moved), float(np.prod([x[1] for x in moved]))
            if goal not in numbers:
                numbers[goal] = len(numbers)
                todo.append(goal)
            row_next.append(numbers[goal])
            row_weight.append(weight)
        nexts.append(row_next)
        weights.append(row_weight)
    return nexts, weights


INSULT, THREAT, TARGET, NEGATION, REPORT = range(1, 6)
GRAMMAR = compose([
    countdown(TARGET, 4, 1.5, (INSULT,)),  # "you are an idiot"
    countdown(NEGATION, 3, 0.4, (INSULT, THREAT)),  # "not stupid"
    lasting(REPORT, 0.6, (INSULT, THREAT)),  # "he said they were ..."
])
#: A threat counts in full only towards someone: the clause is looked at again when its target comes after the verb.
THREAT_ALONE, THREAT_REACH = 0.2, 3


@dataclass
class ToxicModel:
    """Log-odds of words and stems, base weights of seeds, and the coefficients of the clause features."""

    atoms: dict[str, float]
    coefficients: np.ndarray


def atoms_of(word: str) -> list[str]:
    """A word and its stems, most special first."""
    return [word, *(word[:k] + "*" for k in reversed(STEMS) if len(word) > k)] if len(word) >= STEMS[0] else [word]


class Tagger(dict):
    """Symbol and weight of a word, kept for words seen before."""

    def __init__(self, atoms: dict[str, float]):
        super().__init__()
        self.atoms = atoms
        self.seeds = {w: SYMBOLS.index(c) for c in SEEDS for w in SEEDS[c].split()}

    def __missing__(self, word: str) -> tuple[int, float]:
        if len(self) >= _CACHE:
            self.clear()
        known = next((self.atoms[a] for a in atoms_of(word) if a in self.atoms), None)
        symbol = self.seeds.get(word, 0)
        if symbol in (INSULT, THREAT):
            found = symbol, max(2.0, known or 0.0)
        elif symbol == 0 and known is not None and known >= LEAST_ODDS:
            found = INSULT, known
        else:
            found = symbol, 0.0
        self[word] = found
        return found


def clause_features(text: bytes | None, tag: Tagger) -> tuple[float, float, float, float]:
    """Heaviest clause, log of the clauses' weights together, log of matched clauses, and heaviest by length of text."""
    if not text:
        return 0.0, 0.0, 0.0, 0.0
    words = TOKEN.findall(text.decode("utf-8").lower())
    tagged = list(map(tag.__getitem__, words))
    nexts, factors = GRAMMAR
    state, clause, clauses, threat = 0, 0.0, [], []
    for at, (symbol, weight) in enumerate(tagged):
        if symbol == 0:
            word = words[at]
            if len(word) == 1 and not word.isalnum():
                if clause:
                    clauses.append(clause)
                    clause = 0.0
                if word not in ",;:":
                    state = 0
                continue
            state = nexts[state][0]
            continue
        if symbol == INSULT:
            clause += weight * factors[state][INSULT]
        elif symbol == THREAT:
            near = any(s == TARGET for s, _ in tagged[max(0, at - THREAT_REACH) : at + THREAT_REACH + 1])
            clause += weight * factors[state][THREAT] * (1.0 if near else THREAT_ALONE)
        state = nexts[state][symbol]
    if clause:
        clauses.append(clause)
    if not clauses:
        return 0.0, 0.0, 0.0, 0.0
    most, total = max(clauses), sum(clauses)
    return most, float(np.log1p(total)), float(np.log1p(len(clauses))), float(np.log1p(1000 * total / (len(words) + 50)))


def _sample(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """Labelled texts, about ``fit_rows`` at most: ids below a hash bound that follows from their number."""
    marked = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    n = marked.count()
    if n > fit_rows:
        marked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * fit_rows / n))
    # At most about fit_rows ids go out to every task; the documents are not shuffled.
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(marked), "doc_id")


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicModel:
    """Fit the lexicon and the clause weights to ``labels.toxic`` of the documents given; nothing but their texts is used.

    The driver gets the atoms of at least ``LEAST_DOCS`` of the fitted documents and their features, both bounded by
    ``fit_rows``. Without labels of both kinds the seeds count alone.
    """
    from wayfold.session import durable

    sample = durable(_sample(docs, labels, fit_rows), "toxic-sample")

    def count(batches):
        seen = {0: Counter(), 1: Counter()}
        n = {0: 0, 1: 0}
        for batch in batches:
            for text, toxic in zip(raw(batch, "text"), batch.column("toxic").to_pylist()):
                toxic = int(toxic > 0)
                n[toxic] += 1
                words = {w for w in TOKEN.findall((text or b"").decode("utf-8").lower()) if len(w) > 2}
                seen[toxic].update({a for w in words for a in atoms_of(w)})
        for toxic in (0, 1):
            rows = [("", n[toxic]), *seen[toxic].items()]
            for k in range(0, len(rows), 50_000):
                names, counts = zip(*rows[k : k + 50_000])
                yield pa.RecordBatch.from_pydict({"atom": pa.array(names), "toxic": pa.array([toxic] * len(names), pa.int32()), "n": pa.array(counts, pa.int64())})

    counted = sample.select("text", "toxic").mapInArrow(count, "atom string, toxic int, n long").groupBy("atom").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"),
    ).where((F.col("bad") + F.col("good") >= LEAST_DOCS) | (F.col("atom") == "")).toPandas()
    total = counted[counted["atom"] == ""]
    n_bad, n_good = (float(total["bad"].sum()), float(total["good"].sum())) if len(total) else (0.0, 0.0)
    seeds_only = ToxicModel({}, np.array([-3.0, 1.0, 0.0, 0.0, 0.0]))
    if not n_bad or not n_good:
        return seeds_only
    rows = counted[counted["atom"] != ""]
    odds = np.log(((rows["bad"] + 0.5) / (n_bad + 1)) / ((rows["good"] + 0.5) / (n_good + 1))).to_numpy()
    # A word seen often enough overrides its stems, also where it speaks against them.
    atoms = {a: float(o) for a, o in zip(rows["atom"], odds)}
    hot = {a for a, o in atoms.items() if o >= LEAST_ODDS}
    stems = {a[:-1] for a in hot if a.endswith("*")}
    atoms = {a: o for a, o in atoms.items() if a in hot or any(a.rstrip("*")[:k] in stems for k in STEMS)}
    shared = docs.sparkSession.sparkContext.broadcast(atoms)
    fitted = map_batches(sample.select("text", "toxic"), lambda: _feature_step(shared, ["toxic"]), "toxic int, f0 double, f1 double, f2 double, f3 double").toPandas()
    x = np.column_stack([np.ones(len(fitted)), fitted[[f"f{k}" for k in range(_FEATURES)]].to_numpy()])
    return ToxicModel(atoms, _newton(x, (fitted["toxic"].to_numpy() > 0).astype(float)))


def _newton(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic regression with a ridge on all but the intercept."""
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _feature_step(shared, keep: list[str]):
    tag = Tagger(shared.value)

    def step(batch: pa.RecordBatch) -> dict:
        features = list(zip(*(clause_features(t, tag) for t in raw(batch, "text"))))
        return {k: batch.column(k) for k in keep} | {f"f{k}": list(f) for k, f in enumerate(features)}

    return step


def score(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` and the clause features of every row; null and empty texts score as texts without a match.

    The model's size is bounded by the rows it was fitted on. Map only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.atoms)
    names = ", ".join(f"f{k} double" for k in range(_FEATURES))
    found = map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), lambda: _feature_step(shared, ["doc_id"]), f"doc_id long, {names}")
    z = F.lit(float(model.coefficients[0]))
    for k in range(_FEATURES):
        z = z + F.lit(float(model.coefficients[k + 1])) * F.col(f"f{k}")
    chance = 1 / (1 + F.exp(-z))
    return found.select("doc_id", chance.alias("score"), (chance >= threshold).cast("int").alias("predicted"), *[F.col(f"f{k}") for k in range(_FEATURES)])
