"""Language identification as a mixture: every document may hold several languages.

Each language is a distribution over hashed character trigrams, learned by counting. A document's
language proportions are estimated by expectation-maximisation from the likelihoods of its
trigrams: the share that each language has in producing a trigram, given the present proportions,
is averaged into the next proportions. The set of languages is then chosen by penalised likelihood:
the k most present languages, refitted, for every k, at `PENALTY` times half the logarithm of the
number of trigrams for each language beyond the first. The language with the largest proportion
in the chosen set is the prediction, its proportion the score.

A model has one row of `BUCKETS` numbers per language, so its size does not depend on the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Hashed trigrams per language; 8 bytes each in the model that tasks receive.
BUCKETS = 1 << 15
ROUNDS = 12
PENALTY = 2.0
UNKNOWN = "und"
NEW = ("lang_pred", "score", "lang_set", "gain")
#: Fixed value: odd multipliers that spread three code points over the buckets.
MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def trigrams(text: str) -> np.ndarray:
    """Buckets of the character trigrams of the lower-case text; white space counts as one blank."""
    clean = " " + " ".join(text.lower().split()) + " "
    at = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if len(at) < 3:
        return np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        mixed = at[:-2] * MIX[0] ^ at[1:-1] * MIX[1] ^ at[2:] * MIX[2]
        mixed ^= mixed >> np.uint32(15)
        mixed *= MIX[1]
    return (mixed >> np.uint32(17)).astype(np.int64)


class Model:
    """Languages, and for each trigram bucket its probability under each of them."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts + 0.5
        self.likelihood = np.ascontiguousarray((smooth / smooth.sum(axis=1, keepdims=True)).T)


def learn(documents: DataFrame) -> Model:
    """Trigram counts of the non-null languages of `documents` (`text`, `lang`)."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang"), strict=True):
                count = np.bincount(trigrams(text.as_py()), minlength=BUCKETS)
                lang = lang.as_py()
                sums[lang] = sums[lang] + count if lang in sums else count
        for lang, count in sums.items():
            at = np.nonzero(count)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(count[at])], ["lang", "bucket", "n"])

    learned = documents.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    found = learned.mapInArrow(tasks, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # One array of BUCKETS numbers per language reaches the driver, whatever the corpus is.
    rows = found.groupBy("lang").agg(F.collect_list("bucket").alias("bucket"), F.collect_list("n").alias("n")).orderBy("lang").collect()
    counts = np.zeros((len(rows), BUCKETS))
    for k, row in enumerate(rows):
        counts[k, row["bucket"]] = row["n"]
    return Model([r["lang"] for r in rows], counts)


def _mixture(likelihood: np.ndarray, weight: np.ndarray, share: np.ndarray, rounds: int) -> np.ndarray:
    for _ in range(rounds):
        joint = likelihood * share
        new = (weight / joint.sum(axis=1)) @ joint
        if np.abs(new - share).max() < 1e-3:
            return new
        share = new
    return share


def proportions(model: np.ndarray, text: str) -> tuple[np.ndarray, float]:
    """Language shares of the chosen set under `model` (bucket by language), and nats per trigram gained over equally likely buckets."""
    kinds, counts = np.unique(trigrams(text), return_counts=True)
    size = model.shape[1]
    if not len(kinds):
        return np.full(size, 1.0 / size), 0.0
    likelihood, weight = model[kinds], counts / counts.sum()
    share = _mixture(likelihood, weight, np.full(size, 1.0 / size), ROUNDS)
    total, order = counts.sum(), np.argsort(-share, kind="stable")
    best, chosen = -np.inf, None
    for k in range(1, size + 1):
        if k > 1 and share[order[k - 1]] < 1e-3:
            break  # nothing left to add
        among = order[:k]
        part = share[among] / share[among].sum()
        if 1 < k < size:
            part = _mixture(likelihood[:, among], weight, part, ROUNDS)
        gain = float(weight @ np.log(likelihood[:, among] @ part))
        value = total * gain - PENALTY * 0.5 * (k - 1) * np.log(total)
        if value > best:
            best, chosen = value, (among, part, gain)
    among, part, gain = chosen
    result = np.zeros(size)
    result[among] = part
    return result, gain + np.log(BUCKETS)


def predict(documents: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns `keep` of `documents`, then `lang_pred`, `score`, `lang_set` and `gain`.

    A null text or one without a letter, or a model without languages, gives `und`, score 0 and an
    empty set. Ties of proportion go to the language that sorts first. Kept columns that bear one
    of the new names give way to them.
    """
    new = "lang_pred string, score double, lang_set array<string>, gain double"
    keep = [c for c in keep if c not in NEW]
    shared = documents.sparkSession.sparkContext.broadcast((model.languages, model.likelihood))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, likelihood = shared.value
        for batch in batches:
            found = []
            for text in batch.column("text"):
                text = text.as_py()
                if not languages or not has_letter(text):
                    found.append((UNKNOWN, 0.0, [], 0.0))
                    continue
                share, gain = proportions(likelihood, text)
                present = [x for x, s in zip(languages, share, strict=True) if s > 0]
                found.append((languages[int(share.argmax())], min(float(share.max()), 1.0), present, gain))
            columns = zip(*found, strict=True) if found else [[]] * 4
            types = (pa.string(), pa.float64(), pa.list_(pa.string()), pa.float64())
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + arrays, keep + list(NEW))

    given = documents.select(*dict.fromkeys([*keep, "text"]))
    kinds = [f"`{c}` {given.schema[c].dataType.simpleString()}" for c in keep]
    return given.mapInArrow(tasks, ", ".join([*kinds, new]))


def identify(documents: DataFrame) -> DataFrame:
    """`doc_id, held_out, lang_pred, score, lang_set, gain` for every row of `documents`.

    Learned from the rows whose crc32 of `doc_id` (as text; null counts as empty) modulo 4 is not
    2 and whose text and lang are not null; predicted from the text alone. Repeated rows are
    predicted alike. An empty table gives no rows.
    """
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    marked = documents.select("doc_id", "text", "lang", held_out.alias("held_out"))
    return predict(marked, learn(marked.where("NOT held_out")), ["doc_id", "held_out"])


def keep_identified(documents: DataFrame) -> DataFrame:
    """The documents that a learned language can be named for, with their own columns.

    Rejected are null texts and those without a letter. Text in a language that was not learned is
    given the nearest learned one and stays. How
    well the named one fits is reported (`gain`) and rejects nothing: a rare text may be clean.
    """
    own = documents.columns
    plain = [f"own_{k}" if c in NEW else c for k, c in enumerate(own)]
    found = predict(documents.toDF(*plain), learn(documents), plain)
    return found.where(F.col("lang_pred") != UNKNOWN).select(*plain).toDF(*own)
