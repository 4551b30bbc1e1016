"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text and normalised by length.

Folding lowers case, drops accents, maps homoglyphs and the digits and signs that stand for letters, and turns
all else into blanks, so one entry finds all disguises of a word. Entries are words or word starts, learned from
labelled rows with their log odds. Precise entries say something wherever they are; others, which clean texts hold
by chance, by how dense they are. An exception phrase that covers a hit takes it back.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, only
from .compression_quality import logistic

TOXIC_ROWS, CLEAN_ROWS, BYTES, LONGEST, TERMS, ACCEPT = 1500, 3000, 12_000_000, 187_500, 512, 0.3
#: Entries of this weight or more say something by being there at all, others by how often they are; and how much denser these are in toxic rows.
SURE, DENSER = 4.0, 10.0

#: Letters of other scripts that look like Latin ones, and signs written for letters.
LOOKS = dict(zip("аеорсухіјѕԁһӏпкмтвгɡɑοανρτυικηωßıłøđ", "aeopcyxijsdhlnkmtbrgaoavptuiknwsilod", strict=True))
SIGNS = dict(zip("013456789@$|€", "oieasgtbgasle", strict=True))


class _Fold(dict):
    """Each character's folded form, found once."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFKD", c).lower() if not unicodedata.combining(x))
        out = "".join(LOOKS.get(x, SIGNS.get(x, x)) for x in base)
        self[code] = out = "" if unicodedata.combining(c) else out if out.isalpha() else " "
        return out


_fold = _Fold()


def fold(text: str) -> str:
    """Folded text with one blank between words and at both ends."""
    return f" {' '.join(text.translate(_fold).split())} "


@dataclass(frozen=True)
class Lexicon:
    """Entries are matched on folded text; one that starts with a blank starts a word, one that ends with it ends a word."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    calibration: tuple[float, ...] = (math.log(1 / 9), 0.0, 0.0)
    cache: dict = field(default_factory=dict, compare=False, repr=False)

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "calibration": self.calibration, "cache": {}}

    def automaton(self):
        import ahocorasick

        made = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            made.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            made.add_word(phrase, (len(phrase), None))
        made.make_automaton()
        return made

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """Start, end and weight of what counts: per word start the heaviest entry, without what exceptions cover."""
        if not self.weights:
            return []
        if "auto" not in self.cache:
            self.cache["auto"] = self.automaton()
        found, spared = {}, []
        for end, (n, weight) in self.cache["auto"].iter(folded):
            start = end + 1 - n
            if weight is None:
                spared.append((start, end + 1))
            elif start not in found or weight > found[start][1]:
                found[start] = (end + 1, weight)
        return [(s, e, w) for s, (e, w) in sorted(found.items()) if not any(a <= s and e - 1 <= b for a, b in spared)]

    def features(self, text: str) -> tuple[float, float, float]:
        folded = fold(text)
        weights = [w for _, _, w in self.hits(folded)]
        return 1.0, math.log1p(100 * sum(weights) / (folded.count(" ") + 20)), float(any(w >= SURE for w in weights))

    def score(self, text: str) -> float:
        x = sum(a * b for a, b in zip(self.calibration, self.features(text), strict=True))
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, x))))


def _terms(folded: str) -> set[str]:
    """Words, and word starts of three letters or more, each with its boundary blanks."""
    out = set()
    for w in set(folded.split()):
        out.add(f" {w} ")
        out.update(f" {w[:n]}" for n in range(3, min(len(w), 12) + 1))
    return out


def _dense(rows: list[tuple[str, int]], support: int) -> dict[str, float]:
    """Word starts that toxic rows hold far more densely than clean ones, although clean ones hold them, too; with their weights.

    Greedily: the term that most toxic rows have, of those that are DENSER times as dense on average. A row's density
    is capped, so one row that repeats a word says little.
    """
    def held(text: str) -> dict[str, float]:
        words = text.split()
        count = Counter(f" {w[:n]}" for w in words for n in range(4, min(len(w), 12) + 1))
        return {t: min(c / (len(words) + 20), 0.03) for t, c in count.items()}

    toxic = [held(t) for t, y in rows if y]
    many = Counter(t for d in toxic for t in d)
    clean: Counter = Counter()
    for text, y in rows:
        if not y:
            clean.update({t: x for t, x in held(text).items() if many[t] >= support})
    n1, n0 = max(1, len(toxic)), max(1, len(rows) - len(toxic))
    found: dict[str, float] = {}
    while True:
        mass, many = Counter(), Counter()
        for d in toxic:
            mass.update(d)
            many.update(d.keys())
        ratio = {t: (mass[t] / n1) / ((clean[t] + 0.02) / n0) for t, c in many.items() if c >= support}
        good = [t for t, r in ratio.items() if r >= DENSER]
        if not good:
            return found
        best = min(good, key=lambda t: (-many[t], -len(t), t))
        found[best] = min(math.log(ratio[best]), SURE - 0.1)
        toxic = [d for d in toxic if best not in d]


def learn(rows: list[tuple[str, int]], phrases: tuple[str, ...] = (), terms: int = TERMS, support: int = 4, precision: float = 0.9, share: float | None = None) -> Lexicon:
    """Two of three rows give the lexicon, the others its calibration. phrases are exceptions known beforehand.

    Terms are taken greedily: the one that covers most toxic rows not yet covered, as long as it is precise. Where such
    terms cover few rows each, those that toxic rows hold densely come first.
    """
    folded = [(fold(t), y) for t, y in rows if t]
    train, rest = [r for i, r in enumerate(folded) if i % 3 < 2], folded[2::3]
    toxic, clean = [t for t, y in train if y], [t for t, y in train if not y]
    count: Counter = Counter()
    for t in toxic:
        count.update(_terms(t))
    kept = {w for w, n in count.items() if n >= support}
    against: Counter = Counter()
    for t in clean:
        against.update(_terms(t) & kept)
    even = max(1, len(toxic)) / max(1, len(clean))  # as if there were as many clean rows as toxic ones
    good = {w for w in kept if count[w] / (count[w] + against[w] * max(even, 1.0) + 0.1) >= precision}
    holds = [_terms(t) & good for t in toxic]
    where: dict[str, set[int]] = {}
    for i, s in enumerate(holds):
        for w in s:
            where.setdefault(w, set()).add(i)
    weights: dict[str, float] = {}

    def take(least: int) -> None:
        """Entries that cover ``least`` toxic rows or more that nothing covers yet."""
        while where and len(weights) < terms:
            w = min(where, key=lambda x: (-len(where[x]), -len(x), x))
            got = where.pop(w)
            if len(got) < least:
                where[w] = got
                return
            weights[w] = max(SURE, math.log((count[w] + 0.5) / (len(toxic) + 1)) - math.log((against[w] + 0.1) / (len(clean) + 1)))
            for x in list(where):
                where[x] = where[x] - got
                if not where[x]:
                    del where[x]

    take(max(2, min(2 * support, len(toxic) // 20)))
    first = Lexicon(dict(weights))
    weak = _dense([(t, y) for t, y in train if not (y and first.hits(t))], support)
    covered = {i for i, t in enumerate(toxic) if any(w in t for w in weak)}
    for x in list(where):
        where[x] = where[x] - covered
        if not where[x]:
            del where[x]
    take(2)
    # further words of the same rows: precise terms that are frequent, though other terms cover their rows
    for w in sorted(good, key=lambda x: (-count[x], len(x), x)):
        if len(weights) >= terms or count[w] < 3 * support:
            break
        if not any(w != x and w.startswith(x) for x in weights):
            weights[w] = max(SURE, math.log((count[w] + 0.5) / (len(toxic) + 1)) - math.log((against[w] + 0.1) / (len(clean) + 1)))
    spared = {fold(p) for p in phrases}
    lexicon = Lexicon(weights)
    about: Counter = Counter()
    for t, y in train:
        if any(w in t for w in weights):
            for s, _, _ in lexicon.hits(t):
                a, b = t.rfind(" ", 0, max(s, 0)), t.find(" ", s + 1)
                c = t.find(" ", b + 1)
                for p in (t[max(a, 0) : b + 1], t[s : c + 1] if c > 0 else ""):
                    if p.strip().count(" ") == 1:
                        about[p] += -1000 if y else 1
    spared |= {p for p, n in about.items() if n >= support}
    weights = {**weak, **weights}
    lexicon = Lexicon(weights, tuple(sorted(spared)))
    x = np.array([lexicon.features(t) for t, _ in rest])
    y = np.array([y for _, y in rest], float)
    share = share if share is not None else (sum(y for _, y in folded) / len(folded) if folded else 0.1)
    prior = math.log(max(share, 1e-3) / max(1 - share, 1e-3))
    if len(set(y.tolist())) < 2:
        return Lexicon(weights, lexicon.exceptions, (prior, 1.0, 1.0) if weights else (prior, 0.0, 0.0))
    w = logistic(x, y, ridge=0.02)
    w[0] += prior - math.log(y.sum() / (len(y) - y.sum()))
    return Lexicon(weights, lexicon.exceptions, tuple(w))


def fit_tables(docs: DataFrame, labels: DataFrame, label: str = "toxic", toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS, most_bytes: int = BYTES, longest: int = LONGEST, **more) -> Lexicon:
    """Learns from labelled rows outside the held-out fold: at most toxic_rows and clean_rows of them, chosen by a
    hash of the id, and of those as many whole texts of ``longest`` bytes at most as fit into most_bytes."""
    known = only(labels, "doc_id", label).where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (crc_fold(F.col("doc_id")) != 2)).withColumnRenamed(label, "y")
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Lexicon({})
    ranked = known.withColumn("r", F.xxhash64(F.lit(23), "doc_id"))
    picked = [ranked.where(F.col("y") == k).orderBy("r", "doc_id").limit(n).select("doc_id", "y") for k, n in ((1, toxic_rows), (0, clean_rows))]
    chosen = F.broadcast(picked[0].unionByName(picked[1]).distinct())  # at most toxic_rows + clean_rows ids
    rows = only(docs, "doc_id", "text").where(F.col("text").isNotNull() & (F.octet_length("text") <= longest)).join(chosen, "doc_id").select("doc_id", "y", "text")
    rows = sorted(rows.orderBy(F.xxhash64(F.lit(23), "doc_id"), "y", "text").limit(toxic_rows + clean_rows).collect(), key=lambda r: (r["doc_id"], r["y"], r["text"]))
    used, texts = {0: 0, 1: 0}, []
    for r in rows:
        n = len(r["text"].encode())
        if used[r["y"]] + n <= most_bytes // 2:  # half of the bytes for each label
            used[r["y"]] += n
            texts.append((r["text"], r["y"]))
    return learn(texts, share=counts.get(1, 0) / sum(counts.values()), **more)


def score(df: DataFrame, lexicon: Lexicon, text: str = "text", out: str = "score") -> DataFrame:
    """Adds the score in [0, 1] and the number of hits. One pass, no shuffle; null is an empty text."""
    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])
    at = df.columns.index(text)

    def run(batches):
        for batch in batches:
            got = [lexicon.score(t or "") for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, **more) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs.

    Null or empty text: the score of a text without hits. Null doc_id: kept, not held out. Repeated rows: one
    result each. Empty tables: an empty result; without labels the lexicon is empty. Other columns are not read.
    """
    scored = score(only(docs, "doc_id", "text"), fit_tables(docs, labels, **more))
    return scored.select("doc_id", F.coalesce(crc_fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
