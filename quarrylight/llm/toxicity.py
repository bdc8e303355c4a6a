"""Toxicity by weak supervision.

Many voters - words and word stems that are over-represented in toxic training documents, a list of
known insults, and patterns of shouting and punctuation - vote on every document. A generative label
model, fitted by expectation maximisation on a bounded sample of the labelled training rows, estimates for
each voter how often it fires on toxic and on clean documents, and how strongly voters are correlated
inside a class, both anew in every step; correlated voters share their evidence. The given label is one more voter whose accuracy is
estimated with the rest. A linear (logistic) classifier is then trained on the model's posterior labels and
scores all documents in one pass.

Held-out rows (crc32 of the id modulo 5 is 0) are never read for learning. The sample is drawn by a hash
and holds about MAX_LABELLED rows; voters number at most MAX_VOTERS. Scoring reads whole texts of all rows
and looks at nothing but the text.

Defined cases: null and empty texts get the score of a document without any vote; labels that are null are
not used, ids with several labels count as toxic if one of them is; without toxic or without clean training
rows the known insults alone decide; rows that repeat are scored each; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import require, settle, small_batches

FOLDS = 5
MAX_LABELLED = 20_000
MAX_VOTERS = 600
#: Known insults. Fixed values.
INSULTS = ("idiot", "moron", "stupid", "scum", "trash", "loser", "clown", "worthless", "disgusting", "pathetic", "dumb", "retard", "bastard", "asshole", "bitch", "whore", "slut", "fuck", "shit", "crap")
WORD = re.compile(r"[^\W\d_]+")
NOT_ASCII = re.compile(r"[^\x00-\x7f]+")
CAPITALS = bytes(range(65, 91))
STEMS = (4, 5)
PATTERNS = ("caps", "bangs", "symbols", "repeats")
N_DENSE = len(PATTERNS) + 3
FILES_BATCH = 64
BLOCK = 2048
BROADCAST_ROWS = 200_000


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _capitals(text: str) -> int:
    """Upper-case characters of the whole text; those of ASCII are counted on bytes."""
    data = text.encode("utf-8", "surrogatepass")
    return len(data) - len(data.translate(None, CAPITALS)) + sum(map(str.isupper, "".join(NOT_ASCII.findall(text))))


def _patterns(text: str, words: list[str]) -> list[bool]:
    n = max(len(text), 1)
    return [
        _capitals(text) > 0.5 * len(text),
        text.count("!") > 0.02 * n,
        sum(text.count(c) for c in "#$%&*@") > 0.02 * n,
        len(words) > 20 and len(set(words)) < 0.3 * len(words),
    ]


def _features(text: str) -> set[str]:
    """Distinct words, and stems marked by a trailing star."""
    words = set(WORD.findall(text.lower()))
    return words | {f"{w[:k]}*" for w in words for k in STEMS if len(w) > k}


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for at in range(0, len(pdf), FILES_BATCH):
            part, counts = pdf.iloc[at : at + FILES_BATCH], ({}, {})
            for text, toxic in zip(part["text"], part["toxic"], strict=True):
                side = counts[int(toxic)]
                for f in _features(text or ""):
                    side[f] = side.get(f, 0) + 1
            names = list({*counts[0], *counts[1]})
            yield pd.DataFrame({"feature": names, "clean": [counts[0].get(f, 0) for f in names], "toxic": [counts[1].get(f, 0) for f in names]})


@dataclass
class Model:
    """Voters, and the weights of the linear classifier."""

    voters: list[str]
    weights: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self.words = {v: i for i, v in enumerate(self.voters) if not v.endswith("*")}
        self.stems = {k: {v[:-1]: i for i, v in enumerate(self.voters) if v.endswith("*") and len(v) == k + 1} for k in STEMS}

    def votes(self, text: str) -> tuple[dict[int, int], np.ndarray]:
        """Times that each voter fires, and the dense features."""
        words, fired = WORD.findall(text.lower()), Counter()
        known, (four, five) = self.words, (self.stems[k] for k in STEMS)
        for w in words:
            if w in known:
                fired[known[w]] += 1
            if w[:4] in four and len(w) > 4:
                fired[four[w[:4]]] += 1
            if w[:5] in five and len(w) > 5:
                fired[five[w[:5]]] += 1
        total = sum(fired.values())
        dense = [*map(float, _patterns(text, words)), math.log1p(len(fired)), min(5.0, 50.0 * total / max(len(words), 1)), math.log1p(len(words)) / 8]
        return fired, np.array(dense)

    def score(self, text: str | None) -> float:
        fired, dense = self.votes(text or "")
        z = self.bias + float(dense @ self.weights[-N_DENSE:]) + sum(float(self.weights[i]) for i in fired)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _rows(model: Model):
    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            votes, dense = np.zeros((len(pdf), len(model.voters)), np.uint8), []
            for i, text in enumerate(pdf["text"]):
                fired, d = model.votes(text or "")
                votes[i, list(fired)] = 1
                dense.append(d.tolist())
            yield pd.DataFrame({"toxic": pdf["toxic"], "fired": [row.tobytes() for row in np.packbits(votes, axis=1)], "dense": dense})

    return vote


def _blocks(votes: np.ndarray, dense: np.ndarray | None = None) -> Iterator[tuple[slice, np.ndarray]]:
    """Rows of votes, and of dense columns beside them, as floats: a block at a time, so that no whole matrix of floats is held."""
    for at in range(0, len(votes), BLOCK):
        part = slice(at, at + BLOCK)
        block = votes[part].astype(np.float32)
        yield part, block if dense is None else np.hstack([block, dense[part].astype(np.float32)])


def label_model(votes: np.ndarray, given: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior probability of toxic for each row; rates of firing by class [2, voter]; shares of evidence.

    votes: [row, voter] of 0 and 1. given: labels, one more voter with estimated accuracy. Every step estimates
    rates and correlations anew from the posterior of the step before.
    """
    posterior = 0.02 + 0.96 * given
    together = sum((b.T @ b for _, b in _blocks(votes)), np.zeros((votes.shape[1],) * 2))
    for _ in range(rounds):
        classes = np.stack([1 - posterior, posterior])
        mass = classes.sum(1, keepdims=True)
        sums, toxic_together = np.zeros((2, votes.shape[1])), np.zeros_like(together)
        for part, b in _blocks(votes):
            sums += classes[:, part] @ b
            toxic_together += b.T @ (b * posterior[part, None].astype(np.float32))
        fires, told = (sums + 0.5) / (mass + 1), (classes @ given[:, None] + 0.5) / (mass + 1)
        size = np.zeros_like(together)
        for c, pairs in enumerate((together - toxic_together, toxic_together)):  # correlation of voters inside the classes, weighted by class
            shared = pairs - np.outer(fires[c], sums[c]) - np.outer(sums[c], fires[c]) + mass[c] * np.outer(fires[c], fires[c])
            spread = np.sqrt(np.maximum(np.diag(shared), 0)) + 1e-9
            size += (mass[c] / len(given)) * np.abs(shared / spread[:, None] / spread)
        share = 1 / np.maximum(1.0, np.where(size > 0.2, size, 0).sum(1))
        evidence = np.log(fires[1] / fires[0]) * share
        absent = np.log((1 - fires[1]) / (1 - fires[0])) * share
        z = np.full(len(given), math.log(mass[1, 0] / mass[0, 0]) + absent.sum())
        for part, b in _blocks(votes):
            z[part] += b @ (evidence - absent)
        z = z + np.where(given == 1, math.log(told[1, 0] / told[0, 0]), math.log((1 - told[1, 0]) / (1 - told[0, 0])))
        new = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        moved = np.abs(new - posterior).max()
        posterior = new
        if moved < 1e-3:
            break
    return posterior, fires, share


def fit_linear(votes: np.ndarray, dense: np.ndarray, target: np.ndarray, l2: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by damped Newton steps; a row is its votes and its dense columns."""
    dense = np.hstack([dense, np.ones((len(dense), 1))])
    w = np.zeros(votes.shape[1] + dense.shape[1])
    penalty = np.full(len(w), l2)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        gradient, curve = penalty * w, np.diag(penalty)
        for part, b in _blocks(votes, dense):
            p = 1 / (1 + np.exp(-np.clip(b @ w, -30, 30)))
            gradient = gradient + b.T @ (p - target[part])
            curve += b.T @ (b * np.maximum(p * (1 - p), 1e-4)[:, None].astype(np.float32))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_labelled: int = MAX_LABELLED, max_voters: int = MAX_VOTERS) -> Model:
    """Fit voters, label model and classifier on labelled rows that are not held out."""
    require(docs, id_col, text_col)
    require(labels, id_col, label_col)
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col) != 0).cast("int")).alias("toxic"))
    n = known.count()
    rate = max_labelled / max(n, 1)
    known = known.filter(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) < int(rate * (1 << 30))) if rate < 1 else known
    sample = settle(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id").select("text", "toxic"))  # about max_labelled rows
    n_clean, n_toxic = (sample.filter(F.col("toxic") == c).count() for c in (0, 1))
    if not n_clean or not n_toxic:
        return Model(list(INSULTS), np.r_[np.full(len(INSULTS), 2.0), np.zeros(N_DENSE)], -3.0)
    counts = sample.mapInPandas(_count, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    gain = odds * F.sqrt("toxic")
    least = max(2, n_toxic // 500)
    with small_batches(docs.sparkSession):
        best = counts.filter((F.col("toxic") >= least) & (odds > 1.0)).orderBy(gain.desc(), "feature").limit(max_voters).collect()
    voters = [r["feature"] for r in best]
    voters += [w for w in INSULTS if w not in set(voters)]
    model = Model(voters, np.zeros(len(voters) + N_DENSE), 0.0)
    with small_batches(docs.sparkSession):
        rows = sample.mapInPandas(_rows(model), "toxic int, fired binary, dense array<double>").collect()  # a bit for each voter
    votes = np.unpackbits(np.frombuffer(b"".join(r["fired"] for r in rows), np.uint8).reshape(len(rows), -1), axis=1, count=len(voters))
    given, dense = np.array([r["toxic"] for r in rows], float), np.array([r["dense"] for r in rows])
    posterior, _, _ = label_model(np.hstack([votes, dense[:, : len(PATTERNS)].astype(np.uint8)]), given)
    weights, bias = fit_linear(votes, dense, posterior)
    return Model(voters, weights, bias)


def _scorer(model: Model):
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:  # a batch's texts become strings a few at a time
            yield pa.array([model.score(t) for at in range(0, len(texts), FILES_BATCH) for t in texts.slice(at, FILES_BATCH).to_pylist()], pa.float64())

    return F.arrow_udf(score, "double")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score and predicted of every document."""
    require(docs, id_col, text_col)
    # A null text goes in as an empty one, so that every row gets a score.
    out = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), _scorer(model)(F.coalesce(F.col(text_col), F.lit(""))).alias("score"))
    with small_batches(docs.sparkSession):
        out = settle(out)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def reject(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows of docs that are not predicted toxic: what is scored once is the key of a text, so that no text goes to Python and back."""
    require(docs, text_col)
    text = F.coalesce(docs[text_col], F.lit(""))
    key = (F.xxhash64(text), F.octet_length(text))
    toxic = docs.select(key[0].alias("toxic_key"), key[1].alias("toxic_size"), _scorer(model)(text).alias("toxic_score")).filter("toxic_score >= 0.5")
    with small_batches(docs.sparkSession):
        toxic = settle(toxic.select("toxic_key", "toxic_size").distinct())
    if toxic.count() <= BROADCAST_ROWS:
        toxic = F.broadcast(toxic)
    return docs.join(toxic, (key[0] == toxic["toxic_key"]) & (key[1] == toxic["toxic_size"]), "left_anti")
