"""Language identification by sparse multinomial logistic regression.

Features are hashed character n-grams (one to three letters of the folded
text; whatever is not a letter counts as one border mark), weighted by term frequency
times inverse document frequency.  Document frequencies cover all documents that may
be learned from; the weights are fitted by follow-the-regularised-leader with
an elastic-net penalty on a bounded sample a language, in shards whose states are
averaged after each epoch.  A temperature fitted on sampled documents that the
weights have not seen turns scores into probabilities.  The same documents tell what
share of its n-grams a text of each language has that the language rarely has; a text
with far more is in none of the languages learned, however many they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import map_text, materialize, released, slices
from lapsewise.session import ship_package

#: Sampled documents a language that the weights and the temperature are fitted on.
TRAIN_PER_LANGUAGE = 1500
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
ORDERS = 3
EPOCHS = 4
SHARDS = 4
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.5
SCALE = 10.0
UNKNOWN = "und"
#: An n-gram belongs to a language if this share of its learned documents has it.
FAMILIAR = 0.01
#: A text is of no learned language if its share of other n-grams is over STRANGE times
#: that of all but one in a hundred unseen documents of the language, by more than one
#: over the root of its n-grams; the unseen documents of all languages are the least bound,
#: and the only one of a language with fewer than BOUND_DOCS.
STRANGE = 3.0
BOUND_DOCS = 20
#: Least lead of the best probability over an even guess, of what it could lead by;
#: with four languages a probability of 0.3.
LEAD = 1 / 15

_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """Code point -> lower-case letter, 0 for everything but letters."""
    if not _FOLD:
        table = np.zeros(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(table)
    return _FOLD[0]


def gram_buckets(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each order at every position (-1: no letter in
    it), the first position of each text, and the number of letters of each."""
    joined = "\n\n".join(t or "" for t in texts)
    letters = _fold()[np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")]
    sizes = np.fromiter((len(t or "") + 2 for t in texts), dtype=np.int64, count=len(texts))
    first = np.r_[0, np.cumsum(sizes)]
    first[-1] -= 2
    out = []
    gram = np.zeros(len(letters), dtype=np.uint32)
    seen = np.zeros(len(letters), dtype=bool)
    for order in range(ORDERS):
        n = max(0, len(letters) - order)
        gram = gram[:n] * np.uint32(0x9E3779B1) + letters[order: order + n] * np.uint32(0x85EBCA6B) + np.uint32(order + 1)
        seen = seen[:n] | (letters[order: order + n] > 0)
        mixed = gram ^ (gram >> np.uint32(15))
        mixed = mixed * np.uint32(0x2C1B3C6D)
        mixed ^= mixed >> np.uint32(12)
        bucket = ((mixed * np.uint32(0x297A2D39)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int32)
        out.append(np.where(seen, bucket, -1))
    has = np.r_[0, np.cumsum(letters > 0)]
    return out, first, has[np.minimum(first[1:], len(letters))] - has[first[:-1]]


def _document_frequencies(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Documents, and how many of them hold each bucket; counted over all rows."""

    def run(batches):
        df = np.zeros(BUCKETS, dtype=np.int64)
        total = 0
        for batch in batches:
            for part in slices(batch):
                grams, first, letters = gram_buckets(part.column("text").to_pylist())
                mark = np.zeros(BUCKETS + 1, dtype=bool)
                for a, b, n in zip(first[:-1].tolist(), first[1:].tolist(), letters.tolist()):
                    if n:
                        for g in grams:
                            mark[g[a:b]] = True  # -1 is the spare last place
                        df += mark[:-1]
                        mark[:] = False
                        total += 1
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array(np.r_[-1, np.flatnonzero(df)]), "n": pa.array(np.r_[total, df[df > 0]])})

    ship_package(rows.sparkSession)
    got = rows.select("text").mapInArrow(released(run), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    bucket, n = got.column(0).to_numpy(), got.column(1).to_numpy()
    df = np.zeros(BUCKETS, dtype=np.int64)
    df[bucket[bucket >= 0]] = n[bucket >= 0]
    return int(n[bucket < 0].sum()), df


def _weights(z: np.ndarray, n: np.ndarray, alpha: float = ALPHA, l1: float = L1, l2: float = L2) -> np.ndarray:
    w = -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / alpha + l2)
    return np.where(np.abs(z) <= l1, 0.0, w)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl_pass(z: np.ndarray, n: np.ndarray, examples, alpha: float = ALPHA, l1: float = L1, l2: float = L2) -> None:
    """One pass of FTRL-proximal over (buckets, values, class); z and n change in place."""
    for index, value, label in examples:
        zi, ni = z[index], n[index]
        w = _weights(zi, ni, alpha, l1, l2)
        p = _softmax(value @ w)
        p[label] -= 1.0
        g = value[:, None] * p[None, :]
        sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
        z[index] = zi + g - sigma * w
        n[index] = ni + g * g


class Model:
    """Languages, weights a bucket and language (idf and scale included), bias, temperature,
    the buckets of each language and the largest share of others a text of it has."""

    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float,
                 familiar: np.ndarray, strange: np.ndarray):
        self.languages, self.weights, self.bias, self.temperature = languages, weights, bias, temperature
        self.familiar, self.strange = familiar, strange

    def _logits(self, grams: list[np.ndarray], first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of each text, and the number of its n-grams."""
        table = np.vstack([self.weights, np.zeros((1, len(self.languages)), dtype=np.float32)])
        total = np.zeros((len(first) - 1, len(self.languages)))
        count = np.zeros(len(first) - 1)
        for g in grams:
            edge = np.minimum(first, len(g))
            sums = np.zeros((len(g) + 1, len(self.languages)))
            np.cumsum(table[g], axis=0, out=sums[1:])
            total += sums[edge[1:]] - sums[edge[:-1]]
            seen = np.r_[0, np.cumsum(g >= 0)]
            count += seen[edge[1:]] - seen[edge[:-1]]
        return total / np.maximum(count, 1)[:, None] + self.bias, count

    def logits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        grams, first, letters = gram_buckets(texts)
        return self._logits(grams, first)[0], letters

    def identified(self, texts: list[str | None], lead: float = LEAD) -> np.ndarray:
        """Whether each text has letters, is in a learned language, and that one leads."""
        k = len(self.languages)
        grams, first, letters = gram_buckets(texts)
        logits, count = self._logits(grams, first)
        p = _softmax(logits / self.temperature)
        best = p.argmax(axis=1)
        language = np.repeat(best, np.diff(first))
        odd = np.zeros(len(texts))
        for g in grams:
            edge = np.minimum(first, len(g))
            sums = np.r_[0, np.cumsum((g >= 0) & ~self.familiar[g, language[: len(g)]])]
            odd += sums[edge[1:]] - sums[edge[:-1]]
        count = np.maximum(count, 1)
        leads = p.max(axis=1) * k - 1 >= lead * (k - 1) if k > 1 else True
        return (letters > 0) & (odd / count <= self.strange[best] + 1 / np.sqrt(count)) & leads


def shard_of(draw):
    """The shard of a sampled document, whatever chose it by ``draw``."""
    return F.pmod(F.xxhash64(F.lit("shard"), draw), F.lit(SHARDS))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Learn from all rows with an id, a text and a language; None if there are none."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        "doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    per = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not per:
        return None
    languages = sorted(per)
    total, df = _document_frequencies(rows)
    idf = (np.log((1 + total) / (1 + df)) + 1.0) * SCALE
    code = F.coalesce(*[F.when(F.col("lang") == x, F.lit(i)) for i, x in enumerate(languages)])
    every = F.coalesce(*[F.when(F.col("lang") == x, F.lit(max(1, per[x] // TRAIN_PER_LANGUAGE))) for x in languages])
    draw = F.xxhash64(F.lit("sample"), "doc_id")
    sample = rows.where(F.pmod(draw, every) == 0).select("text", code.alias("label"), draw.alias("draw"))

    def features(batch):
        grams, first, letters = gram_buckets(batch.column("text").to_pylist())
        index, value, keep = [], [], []
        for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
            if letters[i]:
                own = np.concatenate([g[a:b] for g in grams])
                own, times = np.unique(own[own >= 0], return_counts=True)
                index.append(own)
                value.append(times / times.sum() * idf[own])
                keep.append(i)
        keep = pa.array(keep, pa.int64())
        return pa.RecordBatch.from_pydict({
            "label": batch.column("label").take(keep), "draw": batch.column("draw").take(keep),
            "index": pa.array(index, pa.list_(pa.int32())), "value": pa.array(value, pa.list_(pa.float64()))})

    examples = materialize(map_text(sample, features, "label int, draw long, index array<int>, value array<double>"), "examples")
    learn = examples.where("pmod(draw, 5000011) % 5 <> 0")
    k = len(languages)
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))  # the last row is the bias
    shards = materialize(learn.repartition(SHARDS, shard_of(F.col("draw"))).sortWithinPartitions("draw"), "shards")
    sc = docs.sparkSession.sparkContext
    for _ in range(EPOCHS):
        held = sc.broadcast((z, n))

        def train(batches):
            z, n = (x.copy() for x in held.value)
            seen = 0
            for batch in batches:
                index, value = batch.column("index"), batch.column("value")
                labels = batch.column("label").to_pylist()
                seen += len(labels)
                ftrl_pass(z, n, (
                    (np.r_[index[i].values.to_numpy(), BUCKETS], np.r_[value[i].values.to_numpy(), 1.0], labels[i])
                    for i in range(len(labels))))
            if seen:
                at = np.flatnonzero(n.any(axis=1))
                yield pa.RecordBatch.from_pydict({
                    "at": pa.array(at), "z": pa.array(list(z[at]), pa.list_(pa.float64())),
                    "n": pa.array(list(n[at]), pa.list_(pa.float64())), "seen": pa.array(np.full(len(at), seen))})

        got = shards.mapInArrow(released(train), "at long, z array<double>, n array<double>, seen long").toArrow()
        if not got.num_rows:
            break
        at, seen = got.column("at").to_numpy(), got.column("seen").to_numpy().astype(float)
        weight = np.zeros(BUCKETS + 1)
        np.add.at(weight, at, seen)
        z, n = np.zeros_like(z), np.zeros_like(n)
        for target, name in ((z, "z"), (n, "n")):
            rows_of = got.column(name).combine_chunks().flatten().to_numpy().reshape(-1, k)
            np.add.at(target, at, rows_of * seen[:, None])
            target /= np.maximum(weight, 1)[:, None]
    w = _weights(z, n)
    rest = examples.where("pmod(draw, 5000011) % 5 = 0").toArrow()
    logits = np.array([np.asarray(v) @ w[np.asarray(i)] + w[BUCKETS]
                       for i, v in zip(rest.column("index").to_pylist(), rest.column("value").to_pylist())]).reshape(-1, k)
    temperature = _temperature(logits, rest.column("label").to_numpy())
    weights = (w[:BUCKETS] * idf[:, None]).astype(np.float32)
    familiar = np.zeros((BUCKETS, k), dtype=bool)
    have = learn.select("label", F.explode("index").alias("bucket")).groupBy("label", "bucket").count().toArrow()
    label, bucket, held = (have.column(c).to_numpy() for c in ("label", "bucket", "count"))
    size = {r["label"]: r["count"] for r in learn.groupBy("label").count().collect()}
    familiar[bucket, label] = held >= FAMILIAR * np.array([size.get(i, 0) for i in range(k)])[label]
    labels = rest.column("label").to_numpy()
    shares = np.array([(np.asarray(v) / idf[np.asarray(i)])[~familiar[np.asarray(i), x]].sum()
                       for i, v, x in zip(rest.column("index").to_pylist(), rest.column("value").to_pylist(), labels)])
    return Model(languages, weights, w[BUCKETS], temperature, familiar, _strange(shares, labels, k))


def _strange(shares: np.ndarray, labels: np.ndarray, k: int) -> np.ndarray:
    """For each language the share of other n-grams from which a text is of none."""
    if not len(shares):
        return np.ones(k)
    groups = [shares[labels == i] for i in range(k)]
    every = np.quantile(shares, 0.99)
    return STRANGE * np.array([max(every, np.quantile(g, 0.99) if len(g) >= BOUND_DOCS else 0.0) for g in groups])


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss on documents the weights have not seen."""
    if not len(labels):
        return 1.0

    def loss(t):
        return -np.log(_softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean()

    return float(min(np.exp(np.linspace(-1, 3, 81)), key=loss))


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, lang_pred, score) of every row; only the text decides.

    ``und`` with score 0 if the text is null or has no letter, or nothing was
    learned; equal scores go to the first language in order.  Null and repeated
    ids are kept; every row is judged for itself.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(batch):
        model = held.value
        texts = batch.column("text").to_pylist()
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if model is not None:
            logits, letters = model.logits(texts)
            p = _softmax(logits / model.temperature)
            best = p.argmax(axis=1)
            for i in np.flatnonzero(letters > 0):
                names[i], scores[i] = model.languages[best[i]], min(1.0, float(p[i, best[i]]))
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "h": batch.column("h"),
            "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores)})

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    return map_text(rows, kernel, "doc_id long, h long, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """Documents that are never learned from; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def keep_identified(docs: DataFrame, model: Model | None, lead: float = LEAD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all their columns) in a learned language whose probability
    leads by ``lead``; rows without letters or in no learned language go.  Without a model
    (a corpus without labels teaches nothing) nothing can be rejected: all rows stay."""
    if model is None:
        return docs
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    ship_package(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                yield part.filter(pa.array(held.value.identified(part.column(text_col).to_pylist(), lead)))

    return docs.select(*names).mapInArrow(released(run), docs.schema)
