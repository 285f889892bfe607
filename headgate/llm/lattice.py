"""Language-model scores from subword lattices.

The pieces of an existing unigram vocabulary weigh all segmentations of a word: a forward recursion
in log space over the lattice of its pieces gives the word's marginal probability. Pieces start
from the order that the vocabulary's scores give them and are then weighted by expectation-
maximisation over the words of the training documents; characters without a piece fall back to
their bytes, so that every word has a probability. The lattice is the back-off of the words seen in
training: P(word) = (count + types x lattice) / (tokens + types), as many doubts as there are types
(Witten-Bell). A text is its words, one by one, and an end.

Words are counted and weighed once per corpus, not once per document. Documents are dealt to blocks
of rows; a block asks for the words it has, gets their figures, and looks them up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headgate.llm.tables import dropped, kept

#: A public vocabulary file; executors never read it, they get its pieces.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Documents of a block: the words of a block and its texts are one task's memory.
BLOCK = 8192
ROUNDS = 1
#: Distinct words a task counts before it passes them on.
HELD = 500_000
MARK = "▁"  # begins a word in the vocabulary
STOP = 0.25  # probability that a word ends after a piece, before anything is learned


def tokens(text: bytes) -> list[bytes]:
    """Words of UTF-8 text: on bytes, `lower` and `split` know ASCII letters and blanks only."""
    return text.lower().split()


def pieces_of(path: str) -> dict[str, float]:
    """Pieces of a vocabulary file with scores; byte pieces are named `<0xNN>`."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return {model.id_to_piece(i): model.get_score(i) for i in ids if not (model.is_control(i) or model.is_unknown(i))}


def first_weights(scores: dict[str, float]) -> dict[str, float]:
    """Log probabilities of the pieces by the rank of their scores (Zipf); every byte has a piece."""
    named = dict(scores)
    low = min(named.values(), default=0.0)
    for b in range(256):
        named.setdefault(f"<0x{b:02X}>", low)
    order = sorted(named, key=lambda p: (-named[p], p))
    weight = {p: 1.0 / (rank + 2) for rank, p in enumerate(order)}
    total = sum(weight.values())
    return {p: math.log(w / total) for p, w in weight.items()}


class Lattice:
    """Lattices of many words at a time: arrays of words by places, one per piece length.

    `weights` are log probabilities of the pieces; `stop` is the probability that a word ends after
    a piece. Pieces are found by rolling hashes of the code points, tested on a bitmap first.
    """

    CELLS = 1 << 18  # words x places handled at once
    BASE = np.uint64(0x9E3779B97F4A7C15)  # fixed value: odd multiplier of the rolling hash

    def __init__(self, weights: dict[str, float], stop: float = STOP):
        self.stop, self.go = math.log(stop), math.log1p(-stop)
        self.names = [p for p in weights if not (p.startswith("<0x") and len(p) == 6)]
        self.bytes = np.array([weights[f"<0x{b:02X}>"] for b in range(256)]) + self.go
        hashes = np.array([self._hash(p) for p in self.names], dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order
        self.weight = np.array([weights[p] for p in self.names]) + self.go
        self.bitmap = np.zeros(1 << 22, dtype=bool)
        self.bitmap[self.hashes >> np.uint64(42)] = True
        self.longest = max(map(len, self.names), default=1)

    def _hash(self, piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(self.BASE) + ord(c)) & ((1 << 64) - 1)
        return h

    def batches(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places of the words in `words`, their lengths with the mark, and code points padded by 0."""
        sizes = np.array([len(w) for w in words], dtype=np.int64) + 1
        order = np.argsort(sizes, kind="stable")
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end + 1 - at) * sizes[order[end]] <= self.CELLS:
                end += 1
            rows = order[at:end]
            width = int(sizes[rows[-1]])
            text = "".join((MARK + words[r]).ljust(width, "\0") for r in rows.tolist())
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(rows), width)
            yield rows, sizes[rows], codes
            at = end

    def _spelt(self, codes: np.ndarray) -> np.ndarray:
        """Log weight of each character by its bytes; padding cannot be spelt."""
        kinds, at = np.unique(codes, return_inverse=True)
        cost = [-np.inf if c == 0 else self.bytes[list(chr(c).encode("utf-8", "surrogatepass"))].sum() for c in kinds.tolist()]
        return np.array(cost)[at].reshape(codes.shape)

    def arcs(self, codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each piece length: log weights and pieces (-1: none) by word and first place."""
        found, h = [], None
        wide = codes.astype(np.uint64)
        for length in range(1, min(self.longest, codes.shape[1]) + 1):
            h = wide if h is None else h[:, :-1] * self.BASE + wide[:, length - 1 :]
            weight, piece = np.full(h.shape, -np.inf), np.full(h.shape, -1, dtype=np.int64)
            maybe = np.nonzero(self.bitmap[h >> np.uint64(42)])
            names = h[maybe]
            place = np.minimum(np.searchsorted(self.hashes, names), len(self.hashes) - 1)
            hit = self.hashes[place] == names
            where, ids = (maybe[0][hit], maybe[1][hit]), self.ids[place[hit]]
            weight[where], piece[where] = self.weight[ids], ids
            found.append((weight, piece))
        return found

    @staticmethod
    def _add(terms: list[np.ndarray]) -> np.ndarray:
        """Logarithm of a sum; minus infinity where there is nothing to add."""
        top = np.maximum.reduce(terms)
        safe = np.where(np.isfinite(top), top, 0.0)
        with np.errstate(divide="ignore"):
            return safe + np.log(sum(np.exp(t - safe) for t in terms))

    def forward(self, arcs: list, spelt: np.ndarray) -> np.ndarray:
        n, width = spelt.shape
        alpha = np.zeros((width + 1, n))
        for j in range(1, width + 1):
            terms = [alpha[j - k] + arcs[k - 1][0][:, j - k] for k in range(1, min(j, len(arcs)) + 1)]
            alpha[j] = self._add([alpha[j - 1] + spelt[:, j - 1], *terms])
        return alpha

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """Natural log of the summed probability of all segmentations, per word."""
        result = np.empty(len(words))
        for rows, sizes, codes in self.batches(words):
            alpha = self.forward(self.arcs(codes), self._spelt(codes))
            result[rows] = alpha[sizes, np.arange(len(rows))] + self.stop
        return result

    def expected(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Expected number of each piece (in the order of `names`) and of each byte in the words."""
        pieces, spelled = np.zeros(len(self.names)), np.zeros(256)
        for rows, sizes, codes in self.batches(words):
            arcs, spelt = self.arcs(codes), self._spelt(codes)
            alpha = self.forward(arcs, spelt)
            n, width = codes.shape
            each = np.arange(n)
            beta = np.full((width + 1, n), -np.inf)
            beta[sizes, each] = 0.0
            for i in range(width - 1, -1, -1):
                terms = [arcs[k - 1][0][:, i] + beta[i + k] for k in range(1, min(width - i, len(arcs)) + 1)]
                beta[i] = self._add([beta[i], spelt[:, i] + beta[i + 1], *terms])
            whole = alpha[sizes, each]
            for k, (weight, piece) in enumerate(arcs, 1):
                at = np.nonzero((piece >= 0) & (beta[k:].T > -np.inf))
                share = np.exp(alpha[at[1], at[0]] + weight[at] + beta[at[1] + k, at[0]] - whole[at[0]])
                pieces += np.bincount(piece[at], weights=share, minlength=len(pieces))
            with np.errstate(invalid="ignore"):
                share = np.nan_to_num(np.exp(alpha[:-1].T + spelt + beta[1:].T - whole[:, None]))
            kinds, at = np.unique(codes, return_inverse=True)
            sums = np.bincount(at.ravel(), weights=share.ravel(), minlength=len(kinds))
            for c, x in zip(kinds.tolist(), sums.tolist(), strict=True):
                if c:
                    np.add.at(spelled, list(chr(c).encode("utf-8", "surrogatepass")), x)
        return pieces, spelled


def _text(token: bytes) -> str:
    return token.decode("utf-8", "replace").replace("\0", "\ufffd")  # zero pads the arrays


def _names(words: list[bytes]) -> np.ndarray:
    """The words' 64-bit hashes, those of Spark's `xxhash64`."""
    return np.array([xxhash.xxh64_intdigest(w, 42) for w in words], dtype=np.uint64).view(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`block, token, n`: the words of each block, with their number in training documents."""
    block, seen = None, {}

    def out() -> pa.RecordBatch:
        words = list(seen)
        arrays = [pa.array([block] * len(words), pa.int64()), pa.array(words, pa.binary()), pa.array(list(seen.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["block", "token", "n"])

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for at, text, held in zip(batch.column("block").to_pylist(), texts, batch.column("held_out").to_pylist(), strict=True):
            if at != block or len(seen) > HELD:
                if seen:
                    yield out()
                block, seen = at, {}
            for word in tokens(text.as_py() or b""):
                seen[word] = seen.get(word, 0) + (not held)
    if seen:
        yield out()


def _expectations(weights: dict[str, float], stop: float):
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*shared.value)
        sums = np.zeros(len(lattice.names) + 256)
        for batch in batches:
            sums += np.concatenate(lattice.expected(list(map(_text, batch.column("token").to_pylist()))))
        names = lattice.names + [f"<0x{b:02X}>" for b in range(256)]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sums, pa.float64())], ["piece", "n"])

    shared = _share((weights, stop))
    return tasks


def _share(value):
    from pyspark.sql import SparkSession

    return SparkSession.active().sparkContext.broadcast(value)


def _weighed(weights: dict[str, float], stop: float):
    """`h, n, ln`: words with their training count and the log probability of their lattice."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*shared.value)
        for batch in batches:
            found = lattice.log_probabilities(list(map(_text, batch.column("token").to_pylist())))
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("n"), pa.array(found.astype(np.float32))], ["h", "n", "ln"])

    shared = _share((weights, stop))
    return tasks


def learn(words: DataFrame, path: str = VOCABULARY, rounds: int = ROUNDS) -> tuple[dict[str, float], float]:
    """Piece weights and stop probability from a table of training words (`token`, each once).

    The lattice stands for words not seen before, so every word teaches alike. Only sums per piece reach the driver: their number is that of the vocabulary.
    """
    weights, stop = first_weights(pieces_of(path)), STOP
    for _ in range(rounds):
        sums = words.mapInArrow(_expectations(weights, stop), "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        found = {r["piece"]: r["n"] for r in sums.collect()}
        pieces = sum(found.values())
        if not pieces:
            break
        ended = words.count()
        total = pieces + len(weights)  # one more of each, so that none is impossible
        weights = {p: math.log((found.get(p, 0.0) + 1.0) / total) for p in weights}
        stop = min(max(ended / (ended + pieces), 1e-6), 0.999)
    return weights, stop


def _scored(total: int, kinds: int, ends: int, out: pa.Schema):
    """Scores of the documents of one block from the figures of its words."""
    base_of = math.log10(total + kinds + 1)
    end = (math.log10(ends + 1) - base_of, math.log10(max(ends, 0.5)) - math.log10(max(total + kinds, 1)))

    def tasks(docs: pa.Table, figures: pa.Table) -> pa.Table:
        h, n, ln = (figures.column(c).to_numpy() for c in ("h", "n", "ln"))
        order = np.argsort(h)
        h, n, ln = h[order], n[order].astype(np.float64), ln[order].astype(np.float64)
        base = np.log10(n + 1) - base_of
        with np.errstate(divide="ignore"):
            seen = np.log10(n) if kinds else np.full(len(n), -np.inf)
            unseen = ln / math.log(10) + math.log10(max(kinds, 1))
        top = np.maximum(seen, unseen)
        score = top + np.log10(10.0 ** (seen - top) + 10.0 ** (unseen - top)) - math.log10(max(total + kinds, 1))
        sizes, known, bases, scores = [], [], [], []
        for text in docs.column("text").cast(pa.binary()):
            names = _names(tokens(text.as_py() or b""))
            at = np.searchsorted(h, names)
            sizes.append(len(names) + 1)
            known.append(int((n[at] > 0).sum()) + (ends > 0))
            bases.append(float(base[at].sum()) + end[0])
            scores.append(float(score[at].sum()) + end[1])
        made = [pa.array(sizes, pa.int64()), pa.array(known, pa.int64()), pa.array([total] * len(sizes), pa.int64()), pa.array(bases, pa.float64()), pa.array(scores, pa.float64())]
        return pa.Table.from_arrays([docs.column("doc_id"), docs.column("held_out"), *made], schema=out)

    return tasks


def _blocks(documents: DataFrame, held: Column, block: int) -> DataFrame:
    """`doc_id, text, held_out, block`: rows that lie together share a block, in every pass alike.

    Files tell a row's place; other tables are written first, so that their rows have one.
    """
    try:
        place = F.xxhash64(F.col("_metadata.file_path"), F.floor(F.col("_metadata.row_index") / block))
        return documents.select("doc_id", "text", held, place.alias("block"))
    except AnalysisException:
        place = F.floor(F.monotonically_increasing_id() / block)
        return kept(documents.select("doc_id", "text", held, place.alias("block")), "op4-docs")


def score(documents: DataFrame, path: str = VOCABULARY, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """`doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score` for every row.

    A null text is empty, an empty one is its end alone. Held out are rows whose crc32 of `doc_id`
    (as text; null counts as empty) modulo 7 is 2. Repeated rows count as often as they are there.
    Words are matched by 64-bit hash. Other columns are left unread; an empty table gives no rows.
    """
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    docs = _blocks(documents, held.alias("held_out"), block)
    asked = kept(docs.select("text", "held_out", "block").mapInArrow(_counted, "block long, token binary, n long"), "op4-asked")
    words = kept(asked.groupBy("token").agg(F.sum("n").alias("n")), "op4-words")
    seen = words.where("n > 0")
    tokens_, kinds = (x or 0 for x in seen.agg(F.sum("n"), F.count("*")).first())
    ends = docs.where("NOT held_out").count()
    weights, stop = learn(seen.select("token"), path, rounds)
    named = words.select(F.xxhash64("token").alias("h"), "token", "n")
    figures = kept(named.mapInArrow(_weighed(weights, stop), "h long, n long, ln float"), "op4-figures")
    dropped(words)
    # A word may come twice from one block; its figures are the same.
    answers = asked.select("block", F.xxhash64("token").alias("h")).join(figures, "h")
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = "n_tokens long, n_known long, train_tokens long, base_score double, score double"
    out = f"doc_id {kind}, held_out boolean, {names}"
    pairs = docs.groupBy("block").cogroup(answers.groupBy("block"))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(out))
    return pairs.applyInArrow(_scored(tokens_ + ends, kinds + (ends > 0), ends, schema), out)
