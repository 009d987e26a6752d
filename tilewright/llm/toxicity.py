"""Toxicity: boosted trees over dense features of a text, calibrated by isotonic regression.

Features are densities and rates: words of a fixed list of insults; words that labelled rows show to be toxic, in three bands of strength; hits near a
second person; capitals; punctuation; letters replaced by digits or signs, and words spelt out letter by letter, which are put right and looked up again.

The learned words are whole words and beginnings of 3 to 6 letters (endings vary in inflected languages), with the log-odds of the texts that hold
them, shrunk towards no difference. A row that the trees learn from is measured with a lexicon that its own quarter of the rows had no part in, so
the trees see features as good as those of new texts and no better. Trees learn from three quarters, the calibration from the fourth.

The model is fitted on about ``sample`` labelled rows, chosen by a hash of their id; equal texts count once in it, whatever their number. All rows
are scored. Spark joins the chosen ids (no more than the sample, hence broadcast) to the texts, counts words and fits the trees;
the driver sees the lexicon, ``candidates`` entries at most, and the model.

Defined results: a null or empty text has all features 0 and gets the score of such; a null id is not held out and never learned from; ids repeated in
labels are toxic if any of their rows is, null labels are none; repeated documents are scored each. Without labels of both kinds every
score is the share of toxic ones, 0 without any. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.llm.common import as_bytes, groups, ship
from tilewright.session import discard, materialize

#: A starting list of insults in four languages; what labels teach comes on top.
INSULTS = """idiot idiots moron morons stupid dumb dumbass loser losers scum trash garbage pathetic worthless disgusting clown clowns imbecile cretin bastard bitch asshole
jerk freak pig filth vermin retard retarded whore slut dumpf trottel vollidiot idioten arschloch drecksack abschaum versager widerlich dumm blöd blödmann hurensohn schlampe
connard connasse salaud salope abruti crétin débile ordure raclure minable imbécile merde estúpido estúpida idiota imbécil basura escoria inútil patético gilipollas cabrón puta asqueroso""".split()
#: Words that speak to somebody.
SECOND = "you your yours yourself youre u ur du dich dir dein deine deinen deiner ihr euch euer tu toi ton tes vous votre vos usted ustedes vosotros ti tus eres".split()
WORD = re.compile(r"[^\W\d_]+")
DISGUISE = re.compile(r"[0-9@$!*|+]{1,3}(?=[^\W\d_])")
#: Which letter a digit or sign stands for; others are left out.
STANDS_FOR = str.maketrans("0134578@$!|+", "oieastbasiit", "269*")
UPPER, LOWER = (bytes(range(a, a + 26)) for a in (65, 97))
MARKS = b"\"#$%&'()*+,-./:;<=>@[\\]^_`{|}~"
#: Log-odds from which a word belongs to each band.
BANDS = (1.0, 2.0, 3.5)
FEATURES = "insults weak middle strong weight kinds hits near_second second capitals calls marks disguised disguises words".split()
#: Beginnings of words that are looked at.
SHORT, LONG = 3, 6
FOLDS = 5


@dataclass(frozen=True)
class Fit:
    """sample: labelled rows learned from, about; candidates: most frequent words and beginnings of toxic texts that become candidates; min_documents, min_share: toxic texts
    that must hold one; shrink: texts' worth of no difference; near: words between a hit and a second person."""

    sample: int = 50_000
    candidates: int = 50_000
    min_documents: int = 4
    min_share: float = 0.002
    shrink: float = 10.0
    near: int = 5
    trees: int = 20
    depth: int = 3
    step: float = 0.3
    seed: int = 11


def terms_of(word: str) -> Iterator[str]:
    """The word itself, marked by a blank, and its beginnings."""
    yield word + " "
    for n in range(SHORT, min(LONG, len(word)) + 1):
        yield word[:n]


class Lexicon:
    """Log-odds of terms; a word has its highest, 0 below the first band."""

    def __init__(self, odds: dict[str, float]):
        self.odds, self.known = odds, {}

    def of(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= 1 << 18:
                self.known.clear()
            best = max(self.odds.get(t, 0.0) for t in terms_of(word))
            found = self.known[word] = best if best >= BANDS[0] else 0.0
        return found


def disguised(lower: str) -> list[str]:
    """Words in which digits or signs stand between letters, put right."""
    out = []
    for m in DISGUISE.finditer(lower):
        at, end = m.span()
        if at and lower[at - 1].isalpha():
            left = lower[max(0, at - 12) : at].split()[-1]
            right = lower[at : end + 12].split()[0]
            out.append("".join(WORD.findall((left + right).translate(STANDS_FOR))))
    return out


def spelt(words: list[str]) -> list[str]:
    """Words of at least four single letters in a row."""
    out, run = [], []
    for w in [*words, ""]:
        if len(w) == 1:
            run.append(w)
        else:
            if len(run) > 3:
                out.append("".join(run))
            run = []
    return out


def features(text: bytes, lexicon: Lexicon, insults: frozenset[str], second: frozenset[str], near: int) -> list[float]:
    """FEATURES of a text."""
    lower = text.decode("utf-8", "replace").lower()
    words = WORD.findall(lower)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    bands, weight, fixed, hits = [0, 0, 0], 0.0, 0, set()
    for w, k in counts.items():
        odds = lexicon.of(w)
        if odds:
            weight += k * odds
            band = 2 if odds >= BANDS[2] else 1 if odds >= BANDS[1] else 0
            bands[band] += k
            if band:
                hits.add(w)
        if w in insults:
            fixed += k
            hits.add(w)
    addressed = sum(counts[w] for w in second if w in counts)
    close = 0
    if hits and addressed:
        spoken = [i for i, w in enumerate(words) if w in second]
        for i in (i for i, w in enumerate(words) if w in hits):
            at = bisect_left(spoken, i - near)
            close += at < len(spoken) and spoken[at] <= i + near
    hidden = disguised(lower)
    if sum(len(w) == 1 for w in counts) > 2:
        hidden += spelt(words)
    found = sum(w in insults or lexicon.of(w) >= BANDS[1] for w in hidden)
    capitals, small = len(text) - len(text.translate(None, UPPER)), len(text) - len(text.translate(None, LOWER))
    calls, marks = text.count(b"!") + text.count(b"?"), len(text) - len(text.translate(None, MARKS))
    rate = 1000.0 / n
    return [
        fixed * rate, bands[0] * rate, bands[1] * rate, bands[2] * rate, weight * rate, math.log1p(len(hits)), math.log1p(sum(counts[w] for w in hits)), close * rate, addressed * rate,
        capitals / max(1, capitals + small), 1000.0 * calls / len(text), 1000.0 * marks / len(text), found * rate, len(hidden) * rate, math.log1p(n),
    ]


def fold(doc_id: Column) -> Column:
    """0 to 4; 0 is held out. A null id has none."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def known_rows(docs: DataFrame, labels: DataFrame, f: Fit) -> DataFrame:
    """doc_id, text, toxic, fold of the labelled rows to learn from, a row per text."""
    own = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    own = own.withColumn("fold", fold(F.col("doc_id")).cast("int")).where("fold <> 0")
    n = own.count()
    part = min(1.0, f.sample / n) if n else 1.0
    chosen = own.where(F.pmod(F.xxhash64("doc_id", F.lit(f.seed)), F.lit(1 << 30)) < int(part * (1 << 30)))
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = materialize(texts.withColumn("print", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id()), "labelled")
    first = rows.groupBy("print").agg(F.min(F.struct(-F.col("toxic"), "doc_id", "row")).alias("x")).select(F.col("x.row").alias("row"))
    out = rows.join(F.broadcast(first), "row", "left_semi").select("doc_id", "text", "toxic", "fold")
    out._scratch = rows._scratch
    return out


def _count_terms(rows: DataFrame, only: frozenset[str] | None) -> DataFrame:
    """Rows with texts and folds -> term and the texts of each fold that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Counter[str]] = {}

        def emit() -> Iterator[pa.RecordBatch]:
            for k, counts in held.items():
                yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array([k] * len(counts), pa.int32()), pa.array(counts.values(), pa.int64())], ["term", "fold", "n"])
            held.clear()

        for batch in batches:
            for piece in groups([batch], "text", 1 << 20):
                for text, k in zip(as_bytes(piece.column(0)), piece.column(1).to_pylist()):
                    found = {t for w in set(WORD.findall(text.decode("utf-8", "replace").lower())) for t in terms_of(w)}
                    held.setdefault(k, Counter()).update(found if only is None else found & only)
                if sum(map(len, held.values())) > 1 << 19:
                    yield from emit()
        yield from emit()

    counted = rows.select("text", "fold").mapInArrow(run, "term string, fold int, n long")
    return counted.groupBy("term").agg(*(F.sum(F.when(F.col("fold") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(1, FOLDS)))


def learn_lexicon(rows: DataFrame, f: Fit) -> list[dict[str, float]]:
    """Log-odds of terms by all rows, then by all but those of each fold; terms below the first band are left out."""
    sizes = {(r.fold, r.toxic): r.n for r in rows.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = ([sizes.get((k, y), 0) for k in range(1, FOLDS)] for y in (1, 0))
    every = sum(F.col(f"n{k}") for k in range(1, FOLDS))
    often = _count_terms(rows.where("toxic = 1"), None).where(every >= max(f.min_documents, f.min_share * sum(toxic)))
    first = {r[0]: r[1:] for r in often.orderBy(every.desc(), "term").limit(f.candidates).collect()}
    among_clean = {r[0]: r[1:] for r in _count_terms(rows.where("toxic = 0"), frozenset(first)).collect()}
    out = []
    for k in range(FOLDS):
        use = [i for i in range(FOLDS - 1) if i != k - 1]
        n1, n0 = (sum(x[i] for i in use) for x in (toxic, clean))
        share = (n1 + 0.5) / (n1 + n0 + 1)
        odds = {}
        for term, own in first.items():
            d1, d0 = sum(own[i] for i in use), sum(among_clean.get(term, (0,) * 4)[i] for i in use)
            # against what as many texts would hold if kinds were as common as they are
            r = (d1 + f.shrink * share) / (d1 + d0 + f.shrink)
            value = math.log(r / (1 - r)) - math.log(share / (1 - share))
            if value >= BANDS[0]:
                odds[term] = value
        out.append(odds)
    return out


def measure(docs: DataFrame, lexicons: list[dict[str, float]], keep: list[str], f: Fit, by_fold: bool = False) -> DataFrame:
    """The columns ``keep`` and ``features``; by_fold: with the lexicon that the row's own fold had no part in."""
    ship(docs.sparkSession)
    own = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    schema = own.drop("_text").schema.add("features", T.ArrayType(T.DoubleType()))
    if not by_fold:
        lexicons = lexicons[:1]
    insults, second, at = frozenset(INSULTS), frozenset(SECOND), keep.index("fold") if by_fold else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [Lexicon(x) for x in lexicons]
        for batch in groups(batches, "_text", 1 << 20):
            folds = batch.column(at).to_pylist() if by_fold else [0] * batch.num_rows
            rows = [features(text, ready[k], insults, second, f.near) for text, k in zip(as_bytes(batch.column(len(keep))), folds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(rows, pa.list_(pa.float64()))], [x.name for x in schema])

    return own.mapInArrow(run, schema)


@dataclass
class Model:
    """constant: the score if there are no trees; no calibration: the trees' probability stands."""

    lexicons: list[dict[str, float]]
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None
    constant: float = 0.0


def _probability(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    """Adds ``raw``, the trees' probability of toxic."""
    scored = trees.transform(rows.withColumn("features", array_to_vector("features")))
    return scored.withColumn("raw", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def fit(docs: DataFrame, labels: DataFrame, f: Fit = Fit()) -> Model:
    """Learns from the labelled rows that aren't held out: documents(doc_id, text), labels(doc_id, toxic)."""
    ship(docs.sparkSession)
    rows = known_rows(docs, labels, f)
    model = Model(learn_lexicon(rows, f))
    # a few tasks with an order of their own, so that reruns meet the same layout
    measured = measure(rows, model.lexicons, ["doc_id", "toxic", "fold"], f, by_fold=True)
    known = materialize(measured.repartition(4, "doc_id").sortWithinPartitions("doc_id", "features").withColumn("toxic", F.col("toxic").cast("double")), "features")
    discard(rows)
    kinds = {(r.last, r.toxic): r.n for r in known.groupBy((F.col("fold") == FOLDS - 1).alias("last"), "toxic").agg(F.count("*").alias("n")).collect()}
    n = sum(kinds.values())
    model.constant = sum(k for (_, y), k in kinds.items() if y) / n if n else 0.0
    learned, rest = (known.where(F.col("fold") != FOLDS - 1).coalesce(4), known.where(F.col("fold") == FOLDS - 1).coalesce(4))
    if kinds.get((False, 0.0)) and kinds.get((False, 1.0)):
        trees = GBTClassifier(featuresCol="features", labelCol="toxic", maxIter=f.trees, maxDepth=f.depth, stepSize=f.step, maxBins=64, seed=f.seed)
        model.trees = trees.fit(learned.select(array_to_vector("features").alias("features"), "toxic"))
        if kinds.get((True, 0.0)) and kinds.get((True, 1.0)):
            model.calibration = IsotonicRegression(featuresCol="raw", labelCol="toxic").fit(_probability(model.trees, rest).select("raw", "toxic"))
    discard(known)
    return model


def score(docs: DataFrame, model: Model, f: Fit = Fit()) -> DataFrame:
    """documents(doc_id, text) -> doc_id, held_out, score, predicted. A hundredth of the uncalibrated probability stays in the score, so that texts on one step keep their order."""
    if model.trees is None:
        scored = docs.select("doc_id", F.lit(model.constant).alias("score"))
    else:
        scored = _probability(model.trees, measure(docs, model.lexicons, ["doc_id"], f))
        if model.calibration is None:
            scored = scored.withColumn("score", F.col("raw"))
        else:
            step = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prediction")))
            scored = model.calibration.transform(scored).withColumn("score", 0.99 * step + 0.01 * F.col("raw"))
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, f: Fit = Fit()) -> DataFrame:
    """documents(doc_id, text), labels(doc_id, toxic) -> doc_id, held_out, score, predicted."""
    return score(docs, fit(docs, labels, f), f)
