"""Toxicity by a weighted finite-state grammar over clauses.

Three small transducers read the tokens of a clause. The lexicon turns words into symbols (insult, threat, target,
negation, report, other); before the name of a container an insult is taken literally. The scope transducer rewrites symbols
under a negation or in reported speech. The scorer gives weights: an insult counts by its strength, more if it is aimed at
somebody, a threat as much as an insult once its object follows, and both less if denied or reported. They are composed
once into one table; a clause's score is the weight of its path, a text's the logistic of what its matched clauses add
up to.

Insults are learnt from labelled texts, as whole words and as word beginnings: those whose share of toxic texts is
beyond chance among all candidates. A beginning counts if ``FAMILY`` different words of toxic texts share it, so one word does
not lend its beginning to others. Threats (as strong as the median insult), targets, negations and reports are short
fixed lists. Labels are learnt from a bounded sample of rows outside the held-out fifth; of equal texts with different
labels the higher counts. Score inputs are words of the text alone.

Null and empty texts get the score of a text without any match. Without usable labels every score is 0. Repeated rows
are scored one by one. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from .common import values

TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]")
OTHER, STOP, INSULT, THREAT, TARGET, NEGATION, REPORT, THING = range(8)
WORDS = {
    THREAT: "kill hurt destroy burn shoot stab beat punish hang strangle",
    TARGET: "you your yours yourself him her them they he she these those people",
    NEGATION: "not no never nobody hardly without isn aren wasn don doesn didn",
    # Nouns after which a word for refuse means refuse.
    THING: "can cans bin bins bag bags basket collector",
    REPORT: "said says say called calls quoted quotes wrote writes claimed claims told according reported",
}
#: Labelled texts that the lexicon and the weights are learnt from, at most.
SAMPLE = 20_000
#: Entries of the learnt lexicon, at most, and the lengths of the word beginnings that may enter it.
ENTRIES, STEMS = 2_000, (4, 5, 6)
#: Share of toxic texts among those with a term, at least, and standard deviations of certainty in its strength.
PURITY, CERTAINTY = 0.9, 1.96
MOST_ODDS = 6.0
#: Different words of toxic texts that share a beginning, at least.
FAMILY = 3
#: Tokens that a negation reaches, and in which a threat's object follows.
REACH = 3
#: Tokens whose symbols are kept per task, and terms a task counts before it passes them on.
KEPT, HELD_TERMS = 100_000, 50_000


class Machine(NamedTuple):
    """A deterministic transducer: (state, symbol) -> (next state, output). Symbols not listed keep the state."""

    start: object
    step: dict


def scope() -> Machine:
    """Marks insults and threats that stand after a report in the clause, or within reach of a negation."""
    step = {}
    for reported in (False, True):
        for left in range(REACH + 1):
            state = (reported, left)
            calm = (reported, max(left - 1, 0))
            for symbol in (OTHER, TARGET, THING):
                step[state, symbol] = (calm, (symbol, False, False))
            for symbol in (INSULT, THREAT):
                step[state, symbol] = (calm, (symbol, left > 0, reported))
            step[state, NEGATION] = ((reported, REACH), (NEGATION, False, False))
            step[state, REPORT] = ((True, left), (REPORT, False, False))
    return Machine((False, 0), step)


def scorer(aimed: float = 0.5, denied: float = 0.2, reported: float = 0.5) -> Machine:
    """Factors for the strength of a match: more once a target was named in the clause, less if denied or reported.

    A threat gives its factor to the target that follows within ``REACH`` tokens; a target's strength is a threat's.
    """
    step, cuts = {}, {(under, told): (denied if under else 1.0) * (reported if told else 1.0) for under in (False, True) for told in (False, True)}
    for target in (False, True):
        for left in range(REACH + 1):
            for cut in {0.0, *cuts.values()} if left else {0.0}:
                state = (target, left, cut)
                later = (target, left - 1, cut if left > 1 else 0.0) if left else state
                for symbol in (OTHER, NEGATION, REPORT, THING):
                    step[state, (symbol, False, False)] = (later, 0.0)
                step[state, (TARGET, False, False)] = ((True, 0, 0.0), cut * (1 + aimed))
                for scope_of, factor in cuts.items():
                    step[state, (INSULT, *scope_of)] = (later, factor * (1 + aimed * target))
                    step[state, (THREAT, *scope_of)] = ((target, REACH, factor), 0.0)
    return Machine((False, 0, 0.0), step)


def compose(first: Machine, second: Machine) -> Machine:
    """The machine that feeds the output of ``first`` to ``second``."""
    start, step = (first.start, second.start), {}
    open_states = [start]
    symbols = {symbol for _, symbol in first.step}
    while open_states:
        a, b = state = open_states.pop()
        if any((state, symbol) in step for symbol in symbols):
            continue
        for symbol in symbols:
            after, out = first.step[a, symbol]
            then, weight = second.step[b, out]
            step[state, symbol] = ((after, then), weight)
            open_states.append((after, then))
    return Machine(start, step)


class Grammar:
    """The composed machine with a lexicon: word or word beginning (ending in ``*``) -> strength."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.machine = lexicon, compose(scope(), scorer())
        self.threat = float(np.median(list(lexicon.values()))) if lexicon else 0.0
        self.fixed = {w: k for k, words in WORDS.items() for w in words.split()} | dict.fromkeys(".!?;\n", STOP)

    def symbols(self) -> dict[str, tuple[int, float]]:
        """A table of symbols that fills itself as tokens are looked up."""
        grammar = self

        class Table(dict):
            def __missing__(self, token):
                if len(self) > KEPT:
                    self.clear()
                self[token] = found = grammar.symbol(token)
                return found

        return Table()

    def symbol(self, token: str) -> tuple[int, float]:
        strength = max([self.lexicon.get(token, 0.0), *(self.lexicon.get(f"{token[:n]}*", 0.0) for n in STEMS)])
        if strength:
            return INSULT, strength
        kind = self.fixed.get(token, OTHER)
        return kind, self.threat if kind == TARGET else 0.0

    def clause_scores(self, text: str, table: dict) -> list[float]:
        """Scores of the clauses that hold an insult or a threat."""
        found = list(map(table.__getitem__, TOKEN.findall(text.lower())))
        for i, (kind, _) in enumerate(found[:-1]):
            if kind == INSULT and found[i + 1][0] == THING:
                found[i] = (OTHER, 0.0)
        hits = [i for i, (kind, _) in enumerate(found) if kind == INSULT or kind == THREAT]
        scores, done = [], -1
        for hit in hits:
            if hit < done:
                continue
            start = hit
            while start and found[start - 1][0] != STOP:
                start -= 1
            state, total, done = self.machine.start, 0.0, start
            while done < len(found) and found[done][0] != STOP:
                kind, strength = found[done]
                state, factor = self.machine.step[state, kind]
                total += factor * strength
                done += 1
            if total:
                scores.append(total)
        return scores


def _inputs(scores: list[float]) -> tuple[float, float]:
    return (max(scores), math.log1p(sum(scores))) if scores else (0.0, 0.0)


def held_out(id_column: Column) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % 5 == 0


def _terms(text: str) -> set[str]:
    words = set(re.findall(r"[^\W\d_]+", text.lower()))
    return words | {f"{w[:n]}*" for w in words for n in STEMS if len(w) >= n}


def learn_lexicon(sample: DataFrame, scratch: Scratch, entries: int = ENTRIES) -> dict[str, float]:
    """Strengths (log odds) of terms that mark toxic texts beyond chance, from ``sample`` (text, toxic)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())  # of clean and of toxic texts

        def told() -> pa.RecordBatch:
            terms = list(counts[0].keys() | counts[1].keys())
            columns = [pa.array([c[t] for t in terms], pa.int64()) for c in reversed(counts)]
            for c in counts:
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *columns], names=["term", "toxic", "clean"])

        for batch in batches:
            for text, label in zip(values(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                counts[bool(label)].update(_terms(text or ""))
                if len(counts[0]) + len(counts[1]) > HELD_TERMS:
                    yield told()
        yield told()

    sizes = sample.agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")).first()
    if not sizes["toxic"] or not sizes["clean"]:
        return {}
    share = sizes["toxic"] / (sizes["toxic"] + sizes["clean"])
    terms = sample.select("text", "toxic").mapInArrow(run, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    terms = scratch.store(terms, "terms")
    many = max(2, terms.count())
    n, k = F.col("toxic") + F.col("clean"), F.col("toxic")
    part = k / n
    surprise = 2 * (k * F.log(part / share) + F.when(k < n, (n - k) * F.log((1 - part) / (1 - share))).otherwise(0.0))
    # The share of toxic texts is at least this (Wilson's bound), so rare terms count for less.
    z2 = CERTAINTY**2
    least = (part + z2 / (2 * n) - CERTAINTY * F.sqrt(part * (1 - part) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    odds = F.log(least / (1 - least) * ((1 - share) / share))
    # Beyond chance: the likelihood ratio of the best of so many candidates would not reach this.
    words = terms.where((F.col("toxic") > 0) & ~F.col("term").endswith("*")).select("term")
    stems = words.select(F.explode(F.array(*[F.when(F.length("term") >= size, F.concat(F.substring("term", 1, size), F.lit("*"))) for size in STEMS])).alias("term"))
    families = stems.where("term IS NOT NULL").groupBy("term").count().where(F.col("count") >= FAMILY).select("term")
    whole = terms.where(~F.col("term").endswith("*")).unionByName(terms.join(families, "term", "left_semi"))
    telling = whole.where((k > 0) & (part >= PURITY)).select("term", surprise.alias("surprise"), odds.alias("odds"))
    rows = telling.where(F.col("surprise") > 2 * math.log(many)).orderBy(F.desc("surprise"), "term").limit(entries).collect()
    return {r["term"]: min(r["odds"], MOST_ODDS) for r in rows if r["odds"] > 0}


def _logistic(inputs: np.ndarray, labels: np.ndarray, decay: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights and intercept by Newton's method with a small quadratic penalty."""
    x = np.column_stack([inputs, np.ones(len(inputs))])
    weights, penalty = np.zeros(x.shape[1]), decay * np.eye(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (labels - p) - penalty @ weights
        weights += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, slope)
    return weights


class Model(NamedTuple):
    grammar: Grammar
    weights: np.ndarray


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE, scratch: Scratch | None = None) -> Model | None:
    """A model from at most ``sample`` labelled texts outside the held-out fifth, those with the lowest hashes of ids."""
    scratch = scratch or Scratch(docs.sparkSession)
    usable = labels.where(F.col("toxic").isNotNull() & F.col(id_column).isNotNull() & ~held_out(F.col(id_column)))
    usable = usable.groupBy(F.col(id_column).alias("id")).agg(F.max("toxic").alias("toxic"))
    chosen = usable.orderBy(F.xxhash64("id"), "id").limit(sample)  # bounded by ``sample``, so it may be broadcast
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").groupBy("text").agg(F.max("toxic").cast("long").alias("toxic"))
    rows = scratch.store(rows, "labelled")
    lexicon = learn_lexicon(rows, scratch)
    if not lexicon:
        return None
    grammar = Grammar(lexicon)
    found = rows.mapInArrow(_runner(Model(grammar, np.zeros(3)), "toxic", raw=True), "toxic long, strongest double, whole double").collect()  # at most ``sample`` rows
    inputs = np.array([[r["strongest"], r["whole"]] for r in found])
    return Model(grammar, _logistic(inputs, np.array([r["toxic"] for r in found], float)))


def _runner(model: Model | None, id_name: str, raw: bool = False):
    """Scores (text, id) batches; ``raw`` gives the inputs of the logistic instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.grammar.symbols() if model else {}
        for batch in batches:
            inputs = [_inputs(model.grammar.clause_scores(text or "", table)) if model else (0.0, 0.0) for text in values(batch.column(0))]
            x = np.array(inputs, float).reshape(-1, 2)
            if raw:
                columns, names = [pa.array(x[:, 0]), pa.array(x[:, 1])], [id_name, "strongest", "whole"]
            else:
                score = 1 / (1 + np.exp(-np.clip(x @ model.weights[:2] + model.weights[2], -30, 30))) if model else np.zeros(len(x))
                columns, names = [pa.array(score)], [id_name, "score"]
            yield pa.RecordBatch.from_arrays([batch.column(1), *columns], names=names)

    return run


def score(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every text."""
    columns = docs.select(F.col(text_column).alias("text"), F.col(id_column).alias("id"))
    scored = columns.mapInArrow(_runner(model, id_column), f"{id_column} {dict(docs.dtypes)[id_column]}, score double")
    return scored.select(id_column, held_out(F.col(id_column)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model | None, text_column: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` but those whose text the model calls toxic."""
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_only = lambda batch: pa.RecordBatch.from_arrays([batch.column(at)] * 2, names=["text", "id"])
        batches, kept = itertools.tee(batches)
        for scored, batch in zip(_runner(model, "id")(map(text_only, batches)), kept):
            yield batch.filter(pa.array(scored.column(1).to_numpy() < 0.5))

    return docs.mapInArrow(run, docs.schema)
