"""Language identification by hierarchical discrimination.

One-versus-rest linear support vector machines choose a language family; one-versus-one machines then separate the
languages within it. All see only the text, as square roots of the relative frequencies of hashed one- to
three-letter sequences. The machines are fitted in one task, from at most ``per_language`` labelled texts of each
language (``MOST_TEXTS`` altogether, of the ``MOST_LANGUAGES`` most frequent labels), those with the least hash of
their id; the driver gets the fitted weights alone. Texts are turned into features, and predicted, where they lie.

The machines always choose some language. ``lang_known`` tells whether the text is in it at all: whether its letter
sequences are likely enough, under the language's own frequencies, beside those of the texts that were learned from: not
much less so than for the least likely two in a hundred, so that a few wrong labels change nothing. That is false for jumbled letters and for languages that weren't learned, and holds for short texts as for long ones, since it
is a mean over sequences.

Defined cases: a null text, or one without a letter, is ``UNDETERMINED`` with score 0 and not known, as is every text when there are no
labels to learn from; with one learned language every text with a letter gets it, with score 1; null labels are not
learned from; rows without an id are predicted but not learned from; repeated rows are all predicted, and learned from within the
bound; other columns pass through, an existing ``lang_pred``, ``score`` or ``lang_known`` is replaced; texts of any
length count whole.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .piece_bpe import with_column, with_field
from .scratch import trimmed

UNDETERMINED = "und"
BUCKETS = 4096
#: The bound of the training sample: texts of each language.
PER_LANGUAGE = 400
#: Texts of the sample altogether (with more than sixteen languages each has fewer, but two at least), and languages.
MOST_TEXTS = 6400
MOST_LANGUAGES = 1000
#: The share of learned texts that may be mislabelled, and how far below the rest a text may lie, as a multiple of what lies
#: between the least likely of the rest and the median.
ODD, SLACK = 0.02, 2.0
# ISO 639-1 codes by language family. A code that isn't listed is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fy", "is", "lb", "nl", "no", "sv", "yi"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "ky", "tr", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
    "semitic": ["ar", "he", "mt"],
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


@cache
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def features(text: str | None) -> np.ndarray | None:
    """``BUCKETS`` square-rooted frequencies, or None without a letter. What isn't a letter counts as one space."""
    code = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    if not letter.any():
        return None
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    code = np.where(letter, code, np.uint32(32))[keep | np.append(letter[1:], False)]
    one = code * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + one[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(0xC2B2AE35) + one[2:]
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    counts = sum(np.bincount(((x ^ (x >> np.uint32(16))) * np.uint32(0x27D4EB2F)) >> shift, minlength=BUCKETS) for x in (one, two, three))
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def linear_svm(x: np.ndarray, y: np.ndarray, rows: np.ndarray | None = None, cost: float = 10.0, epochs: int = 30) -> np.ndarray:
    """Weights (the last one the bias) of a hinge-loss machine for labels -1 and 1 of the given rows, by dual
    coordinate descent. Rows are taken from ``x`` one at a time, so nothing of its size is made."""
    rows = np.arange(len(x)) if rows is None else rows
    norms, alpha, w, bias = np.einsum("ij,ij->i", x, x)[rows] + 1.0, np.zeros(len(rows)), np.zeros(x.shape[1]), 0.0
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            own = x[rows[i]]
            step = min(max(alpha[i] - (y[i] * (own @ w + bias) - 1) / norms[i], 0.0), cost) - alpha[i]
            if step:
                alpha[i] += step
                w += step * y[i] * own
                bias += step * y[i]
    return np.append(w, bias).astype(np.float32)


@dataclass
class Model:
    families: list[str] = field(default_factory=list)
    family_weights: np.ndarray | None = None  # a column for each family
    languages: dict[str, list[str]] = field(default_factory=dict)
    pairs: dict[str, np.ndarray] = field(default_factory=dict)  # a column for each pair of the family's languages
    profiles: dict[str, np.ndarray] = field(default_factory=dict)  # logarithms of a language's frequencies against even ones
    least: dict[str, float] = field(default_factory=dict)  # what a text of the language has at least

    def known(self, x: np.ndarray, language: str) -> bool:
        return likelihood(x, self.profiles[language]) >= self.least[language]

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        """The language of one text's features and a score: the logistic of the least margin that decided."""
        margins = []
        family = self.families[0]
        if len(self.families) > 1:
            by_family = x @ self.family_weights[:-1] + self.family_weights[-1]
            best, second = np.argsort(-by_family, kind="stable")[:2]
            family = self.families[best]
            margins.append((by_family[best] - by_family[second]) / 2)
        names = self.languages[family]
        winner = 0
        if len(names) > 1:
            won = np.zeros((len(names), len(names)))
            a, b = np.triu_indices(len(names), 1)
            won[a, b] = x @ self.pairs[family][:-1] + self.pairs[family][-1]
            won[b, a] = -won[a, b]
            votes = (won > 0).sum(1)
            winner = int(max(range(len(names)), key=lambda k: (votes[k], won[k].sum())))
            margins.append(np.delete(won[winner], winner).min())
        return names[winner], float(1 / (1 + np.exp(-3 * min(margins)))) if margins else 1.0


def likelihood(x: np.ndarray, profile: np.ndarray) -> float:
    """The mean over a text's letter sequences of the logarithm of how much likelier than evenly they are."""
    return float((x * x) @ profile)


def train(x: np.ndarray, labels: list[str]) -> Model:
    model, tag = Model(), np.array(labels, object)
    family = np.array([FAMILY_OF.get(v, v) for v in labels], object)
    model.families = sorted(set(family))
    if len(model.families) > 1:
        model.family_weights = np.stack([linear_svm(x, np.where(family == f, 1, -1)) for f in model.families], 1)
    for f in model.families:
        names = model.languages[f] = sorted(set(tag[family == f]))
        columns = []
        for a, one in enumerate(names):
            for other in names[a + 1 :]:
                rows = np.flatnonzero((tag == one) | (tag == other))
                columns.append(linear_svm(x, np.where(tag[rows] == one, 1, -1), rows))
        if columns:
            model.pairs[f] = np.stack(columns, 1)
        for name in names:
            own = np.flatnonzero(tag == name)
            share = sum(x[k].astype(np.float64) ** 2 for k in own) / len(own)
            model.profiles[name] = np.log((share + 1e-6) / (share.sum() + 1e-6 * BUCKETS) * BUCKETS).astype(np.float32)
            found = [likelihood(x[k], model.profiles[name]) for k in own]
            low, middle = np.quantile(found, [ODD, 0.5])
            model.least[name] = float(low - SLACK * (middle - low))
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that are never learned from: one in four, by the CRC-32 of the id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Fit on the labelled rows that aren't held out, at most ``per_language`` of each label."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).alias("label")).where(~held_out("id") & F.col("id").isNotNull() & F.col("label").isNotNull())
    counted = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(MOST_LANGUAGES)
    counts = {r["label"]: r["n"] for r in counted.collect()}
    if not counts:
        return Model()
    per_language = max(2, min(per_language, MOST_TEXTS // len(counts)))
    # Twice the bound is let through by the hash of the id; the exact bound holds after sorting what came.
    share = F.try_element_at(F.create_map(*(F.lit(v) for label, n in counts.items() for v in (label, min(1.0, 2 * per_language / n)))), F.col("label"))
    order = F.xxhash64(F.col("id").cast("string"))
    chosen = rows.withColumn("order", order).where(F.pmod("order", F.lit(1 << 20)) < share * (1 << 20))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in batch.column("text").to_pylist()]
            keep = [k for k, x in enumerate(found) if x is not None]
            columns = [pa.array([batch.column(c)[k].as_py() for k in keep], kind) for c, kind in (("label", pa.string()), ("order", pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([found[k].tobytes() for k in keep], pa.binary())], ["label", "order", "x"])

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = sorted((row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("label", "order", "x")), strict=True)))
        taken: dict[str, list[bytes]] = {}
        for label, _, x in sample:
            if len(own := taken.setdefault(label, [])) < per_language:
                own.append(x)
        del sample
        labels = [label for label, own in taken.items() for _ in own]
        if labels:
            x = np.frombuffer(b"".join(x for own in taken.values() for x in own), np.float32).reshape(len(labels), BUCKETS)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(x, labels))], pa.binary())], ["model"])

    # The sample is bounded, so one task holds it.
    sample = chosen.select("text", "label", "order").mapInArrow(run, "label string, order bigint, x binary")
    learned = sample.repartition(1).mapInArrow(lambda batches: trimmed(learn(batches)), "model binary").collect()
    return pickle.loads(learned[0]["model"]) if learned else Model()


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1) and ``lang_known``, from ``text_col`` alone."""

    def told(x: np.ndarray | None) -> tuple[str, float, bool]:
        if x is None or not model.families:
            return UNDETERMINED, 0.0, False
        language, score = model.predict(x)
        return language, score, model.known(x, language)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [told(x) for x in map(features, batch.column(text_col).to_pylist())]
            out = batch if keep_text else batch.drop_columns([text_col])
            for k, (name, kind) in enumerate((("lang_pred", pa.string()), ("score", pa.float64()), ("lang_known", pa.bool_()))):
                out = with_column(out, name, pa.array([x[k] for x in found], kind))
            yield out

    source = docs.drop("lang_pred", "score", "lang_known")
    schema = source.schema if keep_text else T.StructType([f for f in source.schema.fields if f.name != text_col])
    for name, kind in (("lang_pred", T.StringType()), ("score", T.DoubleType()), ("lang_known", T.BooleanType())):
        schema = with_field(schema, name, kind)
    return source.mapInArrow(run, schema)
