"""Abusive, hateful and sexual content: a score per document and rates per source.

One pass over all documents counts every combination of votes on their segments and draws a
bounded sample of segments; the label model is fitted to the counts, a linear classifier to the
sample's posteriors; a second pass scores every segment of every document by the classifier alone,
which sees words and their classes but no vote.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from . import voters
from .weaklabels import LabelModel, LinearClassifier, belief, features, fit_linear, joint_features, own_features


@dataclass
class ContentModel:
    labels: dict[str, LabelModel]
    classifiers: dict[str, LinearClassifier]

    def score(self, text: str | None) -> tuple[float, float, float]:
        """Of each category, the greatest score of the text's segments; 0 without any."""
        best = [0.0] * len(voters.CATEGORIES)
        for s in voters.segments(text or ""):
            for k, v in enumerate(self._segment(s)):
                if v > best[k]:
                    best[k] = v
        return tuple(best)

    def _segment(self, s: str) -> tuple[float, ...]:
        known = self.__dict__.setdefault("_known", {})
        got = known.get(s)
        if got is None:
            if len(known) > 100_000:
                known.clear()
            got = known[s] = self._judge(voters.words(voters.repair(s)))
        return got

    def _judge(self, words: list[str]) -> tuple[float, ...]:
        """The classifiers' weights of all categories side by side; a word's own features are summed up once per worker."""
        if "_table" not in self.__dict__:
            each = [self.classifiers[c] for c in voters.CATEGORIES]
            self._table = {f: tuple(k.weights.get(f, 0.0) for k in each) for k in each for f in k.weights}
            self._bias, self._words = [k.bias for k in each], {}
        table, own = self._table, self._words
        x, y, z = self._bias
        for w in words:
            v = own.get(w)
            if v is None:
                if len(own) > 300_000:
                    own.clear()
                got = [table[f] for f in own_features(w, voters.classes(w)) if f in table]
                v = own[w] = tuple(map(sum, zip(*got))) if got else ()
            if v:
                x += v[0]
                y += v[1]
                z += v[2]
        for f in joint_features(words, voters.classes):
            v = table.get(f)
            if v is not None:
                x += v[0]
                y += v[1]
                z += v[2]
        return tuple(1 / (1 + math.exp(-max(-30.0, min(30.0, q)))) for q in (x, y, z))

    def __getstate__(self):
        return {"labels": self.labels, "classifiers": self.classifiers}


#: Belief from which a segment counts as a likely hit when the sample is drawn.
LIKELY = 0.25
#: Likely segments of each voter that the sample holds at least, if there are so many.
EACH = 200

NONE = (0,) * len(voters.CATEGORIES)
_SURVEY = "kind string, category int, mask int, n bigint, draw double, segment string, votes array<int>"


def survey(docs: DataFrame, id_column: str, text: str, sample: int, n_docs: int) -> DataFrame:
    """Counts of vote combinations over all segments, and the sample's segments (likely hits, those of each voter, and others)."""
    known: dict[tuple[int, int], float] = {}

    def believed(c: int, m: int) -> float:
        if (c, m) not in known:
            known[c, m] = float(belief(voters.WORTH[voters.CATEGORIES[c]], np.array([m]))[0])
        return known[c, m]

    share = {True: min(1.0, 4.0 * sample / max(1, n_docs)), False: min(1.0, 1.0 * sample / max(1, n_docs))}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            together: Counter = Counter()
            drawn = []
            by_voter: dict[tuple[int, int], list] = {}
            for i, t in zip(p[id_column], p[text]):
                if not isinstance(t, str):
                    continue
                for k, s in enumerate(voters.segments(t)):
                    masks = voters.judged(s)[1]
                    together[masks] += 1
                    draw = xxhash.xxh64_intdigest(f"{i}:{k}") / 2**64
                    likely = False
                    for c, m in enumerate(masks) if masks != NONE else ():
                        if m and believed(c, m) >= LIKELY:
                            likely = True
                            for v in range(m.bit_length()):
                                if m >> v & 1:
                                    by_voter.setdefault((c, v), []).append((draw, s, list(masks)))
                    if draw < share[likely]:
                        drawn.append(("likely" if likely else "other", None, None, None, draw, s, list(masks)))
            counts: Counter = Counter()
            for masks, n in together.items():
                for c, m in enumerate(masks):
                    counts[c, m] += n
            rows = [("count", c, m, n, None, None, None) for (c, m), n in counts.items()] + drawn
            rows += [("voter", c, v, None, *x) for (c, v), own in by_voter.items() for x in sorted(own)[:EACH]]
            yield pd.DataFrame(rows, columns=["kind", "category", "mask", "n", "draw", "segment", "votes"]).astype({"category": "Int32", "mask": "Int32", "n": "Int64"})

    return docs.select(id_column, text).mapInPandas(run, _SURVEY)


def fit(docs: DataFrame, id_column: str = "doc_id", text: str = "text", sample: int = 6000) -> ContentModel:
    """Label models from all documents; classifiers from at most ``sample`` likely hits, ``EACH`` more a voter and ``sample`` other segments.

    What reaches the driver: at most 2^voters combinations a category (counted over all documents) and the sample.
    An empty corpus gives a model that scores nothing.
    """
    seen = cut(survey(docs, id_column, text, sample, docs.count()))
    counts = seen.where("kind = 'count'").groupBy("category", "mask").agg(F.sum("n").alias("n")).collect()
    rows = []
    for kind in ("likely", "other"):
        rows += seen.where(F.col("kind") == kind).orderBy("draw").limit(sample).select("segment", "votes").collect()
    first = F.row_number().over(Window.partitionBy("category", "mask").orderBy("draw", "segment"))
    rare = seen.where("kind = 'voter'").withColumn("k", first).where(F.col("k") <= EACH).select("draw", "segment", "votes").distinct().collect()
    held = {r.segment for r in rows}
    rows += [r for r in sorted(rare, key=lambda r: (r.draw, r.segment)) if r.segment not in held]
    labels, soft = {}, np.zeros((len(rows), len(voters.CATEGORIES)))
    for c, name in enumerate(voters.CATEGORIES):
        own = [(r.mask, r.n) for r in counts if r.category == c]
        model = labels[name] = LabelModel(voters.VOTERS[name], voters.WORTH[name]).fit(np.array([m for m, _ in own], np.int64), np.array([n for _, n in own], float))
        soft[:, c] = model.posterior(np.array([r.votes[c] for r in rows], np.int64))
    made = [features(voters.words(voters.repair(r.segment)), voters.classes) for r in rows]
    return ContentModel(labels, dict(zip(voters.CATEGORIES, fit_linear(made, soft))))


def score_documents(docs: DataFrame, model: ContentModel, id_column: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_column``, the columns ``keep``, abusive, hateful, sexual: scores in [0, 1] of every row; null, empty and blank texts have 0.

    Rows are kept one for one.  Whole texts count, however long.  The broadcast model is bounded by the sample.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    named = [id_column, *keep]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for p in batches:
            s = np.array([m.score(t if isinstance(t, str) else None) for t in p[text]], float).reshape(len(p), len(voters.CATEGORIES))
            yield pd.DataFrame({**{c: p[c] for c in named}, **{c: s[:, k] for k, c in enumerate(voters.CATEGORIES)}})

    schema = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in named] + [f"{c} double" for c in voters.CATEGORIES]
    return docs.select(*named, text).mapInPandas(run, ", ".join(schema))


def found(scores: DataFrame, id_column: str = "doc_id", threshold: float = 0.5) -> DataFrame:
    """``id_column``, category: one row per category whose score reaches the threshold."""
    each = F.array(*[F.when(F.col(c) >= threshold, F.lit(c)) for c in voters.CATEGORIES])
    return scores.select(id_column, F.explode(F.filter(each, lambda x: x.isNotNull())).alias("category")).distinct()


def rates(scores: DataFrame, source: str = "source", threshold: float = 0.5) -> DataFrame:
    """Documents and rates per source and category, from scores that kept the source; documents without one are a group (null).

    One partial aggregation of the scored rows: the scores are not joined to the documents again.
    """
    long = scores.select(source, F.explode(F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).alias("score")) for c in voters.CATEGORIES])).alias("s"))
    hit = (F.col("s.score") >= threshold).cast("int")
    return long.groupBy(source, F.col("s.category").alias("category")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(hit).alias("n_found"), F.avg(hit).alias("rate"), F.avg("s.score").alias("mean_score"))
