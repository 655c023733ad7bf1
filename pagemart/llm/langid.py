"""Language identification in two steps: the family first, then one-versus-one within it.

Features are hashed n-grams of one to three letters over the whole text. Linear support vector machines are
fitted on a bounded sample of labelled rows; every row is predicted. One machine a family, against
the rest, chooses the family; one machine for each two languages of a family then votes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemart.llm.base import query, slices, table, text_filter, text_kept
from pagemart.llm.pretokens import LETTER, classes, code_points
from pagemart.llm.quality import mixed

#: ISO 639-1 codes by branch; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca co es fr gl it la oc pt rm ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "turkic": "az kk ky tk tr tt ug uz",
    "semitic": "am ar he mt ti",
    "indic": "bn gu hi mr ne or pa sa si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "malayic": "id jv ms su",
}
FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
UNKNOWN = "und"
WIDTH = 2048
#: Labelled rows that the machines are fitted on, shared among the languages.
SAMPLE_ROWS = 4000
CHUNK = 1 << 20


def features(text: str | None, width: int = WIDTH) -> np.ndarray | None:
    """Unit vector of the damped counts of hashed n-grams; None for a text without a letter.

    All that is not a letter counts as a gap; a gap's length does not matter to n-grams of one word.
    """
    counts, before = np.zeros(width, np.int64), np.zeros(2, np.uint64)
    any_letter = False
    for at in range(0, len(text or ""), CHUNK):
        points = code_points(text[at : at + CHUNK].lower())
        letters = classes()[points] == LETTER
        any_letter = any_letter or bool(letters.any())
        signs = np.concatenate([before, np.where(letters, points, 0).astype(np.uint64)])
        before, n = signs[-2:], len(points)
        grams = signs[2:]
        for order in (1, 2, 3):
            if order > 1:
                grams = signs[3 - order : 3 - order + n] * np.uint64(1 << 21 * (order - 1)) + grams
            own = grams if order == 1 else grams[(signs[2:] > 0) | (signs[1:-1] > 0)]
            own = own[own > 0] if order == 1 else own
            counts += np.bincount((mixed(own + np.uint64(order)) >> np.uint64(40)).astype(np.int64) % width, minlength=width)
    if not any_letter:
        return None
    damped = np.sqrt(counts)
    return (damped / np.sqrt((damped * damped).sum())).astype(np.float32)


def fit_machine(rows: np.ndarray, signs: np.ndarray, cost: float = 5.0, passes: int = 12) -> np.ndarray:
    """Weights (the last is the bias) of a linear machine, by dual coordinate descent on the squared hinge loss."""
    rows = np.hstack([rows, np.ones((len(rows), 1), np.float32)]).astype(np.float64)
    weights, duals = np.zeros(rows.shape[1]), np.zeros(len(rows))
    share = np.where(signs > 0, len(rows) / (2 * max(1, (signs > 0).sum())), len(rows) / (2 * max(1, (signs < 0).sum())))
    ridge = 1 / (2 * cost * share)
    norms = (rows * rows).sum(axis=1) + ridge
    rng = np.random.default_rng(0)
    for _ in range(passes):
        for i in rng.permutation(len(rows)):
            slope = signs[i] * (rows[i] @ weights) - 1 + ridge[i] * duals[i]
            new = max(0.0, duals[i] - slope / norms[i])
            if new != duals[i]:
                weights += (new - duals[i]) * signs[i] * rows[i]
                duals[i] = new
    return weights.astype(np.float32)


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    families: dict[str, list[str]] = field(default_factory=dict)
    of_family: dict[str, np.ndarray] = field(default_factory=dict)
    of_pair: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, text: str | None) -> tuple[str, float]:
        vector = features(text)
        if vector is None or not self.languages:
            return UNKNOWN, 0.0
        vector = np.append(vector, np.float32(1))
        name, sure = next(iter(self.families)), 1.0
        if len(self.families) > 1:
            marks = sorted(((float(vector @ w), f) for f, w in self.of_family.items()), key=lambda m: (-m[0], m[1]))
            name, sure = marks[0][1], _sigmoid(marks[0][0] - marks[1][0])
        own = self.families[name]
        if len(own) == 1:
            return own[0], sure
        wins, least, total = dict.fromkeys(own, 0), dict.fromkeys(own, np.inf), dict.fromkeys(own, 0.0)
        for a, b in combinations(own, 2):
            mark = float(vector @ self.of_pair[a, b])
            wins[a if mark >= 0 else b] += 1
            for who, value in ((a, mark), (b, -mark)):
                least[who], total[who] = min(least[who], value), total[who] + value
        best = min(own, key=lambda lang: (-wins[lang], -total[lang], lang))
        return best, sure * _sigmoid(2 * least[best])


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-2 * max(-50.0, min(50.0, x)))))


def fit(labels: list[str], vectors: np.ndarray) -> Model:
    languages = sorted(set(labels))
    families: dict[str, list[str]] = {}
    for lang in languages:
        families.setdefault(FAMILY_OF.get(lang, lang), []).append(lang)
    labels_, home = np.array(labels, object), np.array([FAMILY_OF.get(x, x) for x in labels], object)
    model = Model(languages, dict(sorted(families.items())))
    if len(families) > 1:
        model.of_family = {f: fit_machine(vectors, np.where(home == f, 1, -1)) for f in model.families}
    for own in families.values():
        for a, b in combinations(own, 2):
            some = np.flatnonzero((labels_ == a) | (labels_ == b))
            model.of_pair[a, b] = fit_machine(vectors[some], np.where(labels_[some] == a, 1, -1))
    return model


def held_out(id_col: str) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 2 modulo 4. A null id is held out, too."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS
) -> Model:
    """Fit on about ``sample_rows`` labelled rows that are not held out, never more than twice as many.

    Each language gives an equal share, or all it has. Rows are chosen by a hash of id and text, so the sample does
    not hang on the layout. Only fixed-size vectors of the chosen rows reach the driver.
    """
    rows = text_kept(docs.select(id_col, text_col, lang_col), text_col).where(~held_out(id_col) & F.col(lang_col).isNotNull())
    rows = rows.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return Model()
    share = sample_rows / len(counts)
    rates = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, share / n))))
    place = F.pmod(F.xxhash64("id", F.length("text"), F.lit(11)), F.lit(1 << 30)) / (1 << 30)
    chosen = rows.where(place < rates[F.col("lang")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [features(t) for t in batch.column(1).to_pylist()]
            held = [None if v is None else v.astype(np.float16).tobytes() for v in vectors]
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(held, pa.binary())], names=["id", "lang", "vector"])
            yield out.filter(out.column(2).is_valid())

    sample = chosen.mapInArrow(run, "id string, lang string, vector binary").limit(2 * sample_rows).collect()
    sample = sorted((r.id, r.lang, bytes(r.vector)) for r in sample)
    vectors = np.frombuffer(b"".join(v for _, _, v in sample), np.float16).reshape(-1, WIDTH).astype(np.float32)
    return fit([lang for _, lang, _ in sample], vectors)


def predicted(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``lang_pred`` and ``score`` from the text alone.

    ``und`` with score 0 for a text that is null, empty or without a letter, and for all if nothing was learned.
    """
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            found = [model.predict(t) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "lang_pred", "score"])

    return text_kept(docs.select(id_col, text_col), text_col).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, text_col: str = "text", min_score: float = 0.3) -> DataFrame:
    """The rows, as they were, whose text has a language with at least this score.

    A text that is null, empty or without a letter has none and goes, and so do all if nothing was learned.
    Ids play no part; an empty table gives no rows.
    """

    def keep(text: str | None) -> bool:
        lang, score = model.predict(text)
        return lang != UNKNOWN and score >= min_score

    return docs.where(text_filter(keep, text_col))


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predicted(docs, train(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
