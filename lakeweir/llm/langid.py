"""Language identification in two steps: the family, then the languages within it.

Texts become frequencies of hashed letter n-grams. A linear classifier per
family picks the family, and within it linear support vector machines, one for
each pair of languages, vote for the language. All weights stand in one matrix,
so that a batch of texts is scored with a few numpy calls.
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeweir.llm.common import SLICE_BYTES, text_slices, tidy

#: Language families by ISO 639-1 code. Codes not listed form one more family.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indic": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt",
    "sinitic": "yue zh",
    "celtic": "br cy ga gd",
    "austronesian": "id jv ms tl",
    "dravidian": "kn ml ta te",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

#: Hashed features, and the longest n-gram.
FEATURES = 1 << 15
LONGEST = 3
#: At most so many labelled documents of each language are fitted on.
FIT_PER_LANGUAGE = 800
#: Weights that a prediction gathers at a time.
GATHERED = 1 << 22
#: A text fits its language down to this multiple of how far this share of the learned texts lies below their median.
FIT_REACH, FIT_SHARE = 2.5, 0.005
#: Standard errors that a short text may lie lower.
FIT_ERRORS = 3.0
#: What an n-gram that a language never shows counts as.
UNSEEN = 0.5

_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """A table over code points: true for letters."""
    if not _LETTER:
        _LETTER.append(np.array([unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)]))
    return _LETTER[0]


def hashed_grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(feature, text, has_letter)``: features of all letter n-grams, in the order of their texts.

    Case is folded to lower; each run of other characters counts as one space,
    and texts begin and end with one.
    """
    low = [f" {t.lower()} " if t else "  " for t in texts]
    lengths = np.array([len(t) for t in low])
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(low)), lengths)
    letter = letters()[points]
    has_letter = np.add.reduceat(letter, np.concatenate(([0], np.cumsum(lengths)[:-1])), dtype=np.int64) > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    keep[1:] |= owner[1:] != owner[:-1]
    points, owner, letter = np.where(letter, points, np.uint32(32))[keep], owner[keep], letter[keep]
    features, owners = [], []
    for n in range(1, LONGEST + 1):
        size = len(points) - n + 1
        if size <= 0:
            break
        h = np.full(size, 0x9E3779B9 * n & 0xFFFFFFFF, np.uint32)
        some = np.zeros(size, bool)
        for i in range(n):
            h = (h ^ points[i : i + size]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(13)
            some |= letter[i : i + size]
        some &= owner[:size] == owner[n - 1 :]
        features.append((h ^ (h >> np.uint32(16)))[some] & np.uint32(FEATURES - 1))
        owners.append(owner[:size][some])
    feature, owner = np.concatenate(features), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return feature[order], owner[order], has_letter


def fit_linear(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, cost: float = 1.0, rounds: int = 12) -> np.ndarray:
    """A linear support vector machine by dual coordinate descent; the last weight is the bias."""
    w = np.zeros(FEATURES + 1)
    alpha = np.zeros(len(rows))
    square = np.array([v @ v + 1 for _, v in rows]) + 1 / (2 * cost)
    rng = np.random.default_rng(11)
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            at, values = rows[i]
            slope = signs[i] * (w[at] @ values + w[-1]) - 1 + alpha[i] / (2 * cost)
            new = max(alpha[i] - slope / square[i], 0.0)
            if new != alpha[i]:
                step = (new - alpha[i]) * signs[i]
                w[at] += step * values
                w[-1] += step
                alpha[i] = new
    return w


@dataclass
class Model:
    """Weights of all classifiers side by side, and what each of them decides."""

    languages: list[str] = field(default_factory=list)
    families: list[list[int]] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((FEATURES, 0), np.float32))
    biases: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    profiles: np.ndarray = field(default_factory=lambda: np.zeros((0, FEATURES), np.float32))
    least: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def _sums(self, feature: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sums of each text's weights, gathered for a bounded number of n-grams at a time.

        A text longer than that is summed in parts counted from its own start, so equal texts have equal sums.
        """
        sums = np.zeros((len(counts), len(self.biases)))
        step = max(1, GATHERED // max(1, len(self.biases)))
        bounds = np.concatenate(([0], np.cumsum(counts)))
        some = np.flatnonzero(counts)
        i = 0
        while i < len(some):
            first = bounds[some[i]]
            j = int(np.searchsorted(bounds[some + 1], first + step, side="right"))
            if j > i:
                rows = some[i:j]
                sums[rows] = np.add.reduceat(self.weights[feature[first : bounds[rows[-1] + 1]]], bounds[rows] - first, axis=0, dtype=np.float64)
                i = j
            else:
                last = bounds[some[i] + 1]
                for a in range(first, last, step):
                    sums[some[i]] += self.weights[feature[a : min(a + step, last)]].sum(axis=0, dtype=np.float64)
                i += 1
        return sums

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The language of each text, a score from 0 to 1, and whether the text fits the language.

        ``und``, 0 and no without a letter. The score tells the languages apart;
        a text fits if its n-grams are about as likely in the language as those
        of the texts learned from, the less surely the shorter it is.
        """
        n = len(texts)
        feature, owner, has_letter = hashed_grams(texts)
        if not self.languages:
            return ["und"] * n, np.zeros(n), np.zeros(n, bool)
        counts = np.bincount(owner, minlength=n)
        sums = self._sums(feature, counts)
        margins = sums / np.maximum(counts, 1)[:, None] + self.biases
        families = margins[:, : len(self.families)]
        family = families.argmax(axis=1)
        rest = np.where(np.arange(len(self.families)) == family[:, None], -np.inf, families).max(axis=1)
        sure = 1 / (1 + np.exp(-2 * (families.max(axis=1) - rest)))
        votes = np.full((n, len(self.languages)), -np.inf)
        weakest = np.ones((n, len(self.languages)))
        for f, members in enumerate(self.families):
            own = np.flatnonzero(family == f)
            votes[np.ix_(own, members)] = 0
        for k, (a, b) in enumerate(self.pairs, len(self.families)):
            m = margins[:, k]
            # A whole vote each, and less than one in all for the margins, which break ties.
            soft = np.tanh(m) / (4 * len(self.languages))
            votes[:, a] += (m >= 0) + soft
            votes[:, b] += (m < 0) - soft
            odds = 1 / (1 + np.exp(-4 * m))
            weakest[:, a] = np.minimum(weakest[:, a], odds)
            weakest[:, b] = np.minimum(weakest[:, b], 1 - odds)
        best = votes.argmax(axis=1)
        score = np.where(has_letter, sure * weakest[np.arange(n), best], 0.0)
        likely = np.bincount(owner, weights=self.profiles[best[owner], feature], minlength=n) / np.maximum(counts, 1)
        fits = has_letter & (likely >= self.least[best] - FIT_ERRORS * self.spread[best] / np.sqrt(np.maximum(counts, 1)))
        return [self.languages[b] if ok else "und" for b, ok in zip(best, has_letter, strict=True)], score, fits


def profile(counted: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, float, float]:
    """``(log-frequencies, least, spread)`` of the n-grams of a language's texts, each given as features and counts.

    ``least`` is how likely the n-grams of a text have to be in the mean. It comes
    from the texts themselves, each by the counts of the others; ``spread`` is how
    far single n-grams of a text lie apart.
    """
    total = np.zeros(FEATURES)
    for at, n in counted:
        total[at] += n
    means, spreads = [], []
    for at, n in counted:
        value = np.log((total[at] - n + UNSEEN) / (total.sum() - n.sum() + UNSEEN * FEATURES))
        means.append(n @ value / n.sum())
        spreads.append(np.sqrt(n @ (value - means[-1]) ** 2 / n.sum()))
    middle = np.median(means)
    least = middle - FIT_REACH * (middle - np.quantile(means, FIT_SHARE))
    return np.log((total + UNSEEN) / (total.sum() + UNSEEN * FEATURES)).astype(np.float32), float(least), float(np.mean(spreads))


def fit(labels: list[str], blobs: list[bytes]) -> Model:
    """Fit all classifiers to feature counts of labelled texts (see :func:`_counted`)."""
    if not labels:
        return Model()
    counted, own = [], {}
    total = np.zeros(FEATURES)
    for label, blob in zip(labels, blobs, strict=True):
        at, n = np.frombuffer(blob, np.uint32).reshape(2, -1)
        counted.append((at, n / n.sum()))
        own.setdefault(label, []).append((at, n.astype(float)))
        total[at] += n / n.sum()
    # Rare features count for more: each frequency over the root of its mean.
    scale = 1 / np.sqrt(total / len(blobs) + 1e-6)
    rows = [(at, v * scale[at]) for at, v in counted]
    languages = sorted(set(labels))
    number = {code: i for i, code in enumerate(languages)}
    of = np.array([number[x] for x in labels])
    names = sorted({FAMILY_OF.get(code, "other") for code in languages})
    families = [[i for i, code in enumerate(languages) if FAMILY_OF.get(code, "other") == f] for f in names]
    pairs = [p for members in families for p in combinations(members, 2)]
    fitted = []
    for members in families:
        signs = np.where(np.isin(of, members), 1.0, -1.0)
        fitted.append(fit_linear(rows, signs) if len(families) > 1 else np.zeros(FEATURES + 1))
    for a, b in pairs:
        chosen = np.flatnonzero((of == a) | (of == b))
        fitted.append(fit_linear([rows[i] for i in chosen], np.where(of[chosen] == a, 1.0, -1.0)))
    w = np.stack(fitted, axis=1)
    profiles, least, spread = zip(*[profile(own[code]) for code in languages], strict=True)
    return Model(
        languages, families, pairs, (w[:-1] * scale[:, None]).astype(np.float32), w[-1].astype(np.float32), np.stack(profiles), np.array(least), np.array(spread)
    )


def _counted(batches):
    """The language of each text and its distinct features with their counts, for texts with letters."""
    for batch in batches:
        for part in text_slices(batch, "text"):
            feature, owner, has_letter = hashed_grams(part.column("text").to_pylist())
            bounds = np.searchsorted(owner, np.arange(part.num_rows + 1))
            chosen = np.flatnonzero(has_letter)
            blobs = []
            for i in chosen:
                at, n = np.unique(feature[bounds[i] : bounds[i + 1]], return_counts=True)
                blobs.append(np.concatenate((at, n.astype(np.uint32))).tobytes())
            yield pa.RecordBatch.from_arrays([part.column("lang").take(pa.array(chosen)), pa.array(blobs, pa.binary())], names=["lang", "counts"])


def train(docs: DataFrame, learn: Column, per_language: int = FIT_PER_LANGUAGE) -> Model:
    """Fit on a sample of the rows that ``learn`` allows, at most ``per_language`` of each language.

    The sample is bounded, so what reaches the driver does not grow with the
    corpus: those with the least hash of their id, the same at every run.
    """
    known = docs.where(learn).where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    known = known.select("lang", "text", F.abs(F.xxhash64("doc_id", F.lit(3)) / float(1 << 63)).alias("draw"))
    often = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not often:
        return Model()
    # A part of each language that has its least hashes: texts of a frequent one are not sorted.
    limits = F.create_map(*[F.lit(x) for code, n in often.items() for x in (code, 1.5 * per_language / n + 20 / n)])
    likely = known.where(F.col("draw") <= F.element_at(limits, F.col("lang")))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw", F.xxhash64("text")))
    sample = likely.withColumn("place", first).where(F.col("place") <= per_language).select("lang", "text")
    rows = sorted((r["lang"], bytes(r["counts"])) for r in sample.mapInArrow(_counted, "lang string, counts binary").toLocalIterator())
    return fit([r[0] for r in rows], [r[1] for r in rows])


def with_language(docs: DataFrame, model: Model, language: str, score: str, fits: str) -> DataFrame:
    """All columns and rows of ``docs`` with the prediction from their ``text`` in three more columns."""
    schema = docs.select("*", F.lit("").alias(language), F.lit(0.0).alias(score), F.lit(True).alias(fits)).schema

    def work(batches):
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES // 4):
                codes, scores, fitting = model.predict(part.column("text").to_pylist())
                columns = [*part.columns, pa.array(codes, pa.string()), pa.array(scores), pa.array(fitting)]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, language, score, fits])

    return docs.mapInArrow(tidy(work), schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """The third of the rows that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identified(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for each row of ``docs``.

    A null text, or one without a letter, is ``und`` with score 0. Without any
    labelled row all are. Rows with a null id are predicted but not learned
    from. The prediction is a function of the text alone, so repeated texts have
    one result; other columns are not read.
    """
    model = train(docs.select("doc_id", "text", "lang"), ~held_out())
    out = with_language(docs.select("doc_id", "text"), model, "lang_pred", "score", "fits")
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
