"""Toxicity by a support vector machine on a gap-weighted subsequence kernel.

The kernel of two words counts the ordered quadruples of characters they share, each
occurrence weighted by ``DECAY`` to the power of the stretch it spans (at most ``SPAN``
characters), over the same sum for words of their lengths. An insult with characters put in
between, left out or written apart keeps most of its quadruples. A word begins with a mark, so
that stems count more at the start; single characters written apart are read as one word.

Nyström landmarks are words of the training sentences, those most associated with toxic and
with clean ones; K^-1/2 of their kernel matrix maps any word to a vector, and a linear
(squared hinge) machine is trained on these. Labels belong to documents, so sentences are the
instances of a multiple-instance problem: every sentence of a clean document is clean, and of a
toxic one those are positive whose worst word scores highest; sentences' worst words are
chosen anew with each machine. A sentence's margin is that of its worst word, and a
logistic model on a document's sentence margins gives the score.

In the end the margin of a word is linear in its quadruples, so a table of the quadruples of
the landmarks is all that the tasks need, and each distinct word is scored once a worker.

The model is fitted on at most ``sample`` labelled documents (by a hash of the id), in one
task; every document is scored, with its whole text.

Defined results: a null or empty text has no sentence and gets the score of a document
without words; null labels and labels without a document are not used; without labelled
documents of both classes every score is 0; repeated rows are scored alike; a null id keeps its row;
columns other than the id and the text are only carried where a caller asks for it.
"""

from __future__ import annotations

import pickle
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinia.llm.common import ROW, bucket, release, texts_of, utf8, whole_row

ORDER = 4
SPAN = 7
DECAY = 0.7
BITS = 6
#: Distances of the second to fourth character from the first.
OFFSETS = [c for c in combinations(range(1, SPAN), ORDER - 1)]
WEIGHTS = np.array([DECAY ** (c[-1] + 1) for c in OFFSETS], np.float32)
MARK = 27
#: Words whose margins a worker keeps; it starts anew beyond.
CACHE = 300_000
PUNCTUATION = ".,;:!?\"'()[]{}|-_*#$%&<>/\\"
APART = re.compile(r"(?<!\S)(?:\S[ \t]){2,}\S(?!\S)")


def _alphabet() -> np.ndarray:
    """Symbols 1 to 63 of the characters; 0 stands for no character."""
    codes = np.arange(0x3000) % 36 + 28
    codes[ord("a") : ord("z") + 1] = np.arange(1, 27)
    codes[0] = 0
    return codes.astype(np.int32)


ALPHABET = _alphabet()


def symbols(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words' symbols with ``SPAN`` zeros after each, and where each word begins."""
    pad = "\0" * SPAN
    joined = "".join("\1" + u + pad for u in units)
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4")
    coded = ALPHABET[np.where(points < len(ALPHABET), points, points % 36 + 0x2000)]
    starts = np.cumsum([0] + [len(u) + 1 + SPAN for u in units[:-1]]) if units else np.zeros(0, np.int64)
    if len(starts):
        coded[starts] = MARK
    return coded, starts


def quadruples(coded: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    """The number of the quadruple at each position (all but the last ``SPAN``), with zeros in it
    where the word has ended."""
    n = len(coded) - SPAN
    code = coded[:n]
    for o in offsets:
        code = (code << BITS) | coded[o : o + n]
    return code


def norms(lengths: np.ndarray) -> np.ndarray:
    """Square root of the weights of all quadruples of words of these lengths."""
    total = np.zeros(len(lengths))
    for c, w in zip(OFFSETS, WEIGHTS):
        total += np.maximum(lengths - c[-1], 0) * float(w) ** 2
    return np.sqrt(np.maximum(total, float(WEIGHTS.max()) ** 2))


def complete(code: np.ndarray) -> np.ndarray:
    """Whether no symbol of the quadruple is zero."""
    mask = (1 << BITS) - 1
    ok = code & mask != 0
    for k in range(1, ORDER):
        ok &= (code >> (BITS * k)) & mask != 0
    return ok


def words_of(text: str) -> Iterator[list[str]]:
    """The words of each sentence, in lower case. A sentence ends with a line, or a word in . ! or ?"""
    text = text.lower()
    if APART.search(text):
        text = APART.sub(lambda m: m.group().replace(" ", "").replace("\t", ""), text)
    for line in text.split("\n"):
        words = line.split()
        at = 0
        for k, w in enumerate(words):
            if w[-1] in ".!?":
                yield words[at : k + 1]
                at = k + 1
        if at < len(words):
            yield words[at:]


def core(word: str) -> str:
    return word.strip(PUNCTUATION)


@dataclass
class Machine:
    """Margins of words: a table of quadruples and a bias; and a document's logistic model."""

    codes: np.ndarray
    values: np.ndarray
    bias: float
    logistic: np.ndarray
    _table: np.ndarray | None = field(default=None, repr=False)
    _known: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_table": None, "_known": {}}

    def forget(self) -> None:
        """Drops what can be made anew: a worker outlives its task."""
        self._table = None
        self._known.clear()

    def margins(self, words: list[str]) -> np.ndarray:
        """The margin of each word."""
        if self._table is None:
            self._table = np.zeros(1 << (BITS * ORDER), np.float32)
            self._table[self.codes] = self.values
        out = np.full(len(words), self.bias)
        for k in range(0, len(words), 20_000):
            units = [core(w) for w in words[k : k + 20_000]]
            coded, starts = symbols(units)
            total = np.zeros(len(coded) - SPAN if len(units) else 0, np.float32)
            for c, w in zip(OFFSETS, WEIGHTS):
                total += w * self._table[quadruples(coded, c)]
            if len(units):
                sums = np.add.reduceat(np.concatenate((total, np.zeros(SPAN, np.float32))), starts)
                out[k : k + len(units)] += sums / norms(np.array([len(u) + 1 for u in units]))
        return out

    def sentence_margins(self, sentences: list[list[str]]) -> np.ndarray:
        new = list({w for s in sentences for w in s if w not in self._known})
        if len(self._known) + len(new) > CACHE:
            self._known.clear()
            new = list({w for s in sentences for w in s})
        self._known.update(zip(new, self.margins(new).tolist()))
        known = self._known
        return np.array([max([known[w] for w in s]) for s in sentences])

    def document_features(self, margins: np.ndarray, words: int) -> np.ndarray:
        """Of a document's sentence margins: the two largest, how many are positive, its length."""
        if not len(margins):
            return np.array([-2.0, -2.0, 0.0, 0.0, 1.0])
        top = np.sort(margins)[::-1]
        second = top[1] if len(top) > 1 else -2.0
        return np.array([top[0], max(second, -2.0), np.log1p((margins > 0).sum()), np.log1p(words), 1.0])

    def score(self, text: str) -> tuple[float, int | None]:
        """The score, and the number of the worst sentence from 0."""
        sentences = list(words_of(text))
        margins = self.sentence_margins(sentences) if sentences else np.zeros(0)
        x = self.document_features(margins, sum(map(len, sentences)))
        z = float(np.clip(x @ self.logistic, -30, 30))
        return 1 / (1 + np.exp(-z)), int(margins.argmax()) if len(margins) else None


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps on the violators."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        bad = y * (x @ w) < 1
        xb, cb = x[bad], weight[bad]
        new = np.linalg.solve((xb * cb[:, None]).T @ xb + ridge * np.eye(x.shape[1]), xb.T @ (cb * y[bad]))
        if np.abs(new - w).max() < 1e-6:
            return new
        w = new
    return w


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1]), x.T @ (y - p) - ridge * w
        )
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


class _Landmarks:
    """The Nyström map of a set of landmark words."""

    def __init__(self, words: list[str]) -> None:
        self.words = [core(w) for w in words]
        rows, codes, values = self._sparse(self.words)
        self.codes, at = np.unique(codes, return_inverse=True)
        self.by_code = np.zeros((len(self.codes) + 1, len(words)), np.float32)
        np.add.at(self.by_code, (at, rows), values)
        self.by_code /= norms(np.array([len(u) + 1 for u in self.words])).astype(np.float32)
        kernel = self.similar(self.words)
        lam, vec = np.linalg.eigh((kernel + kernel.T) / 2)
        keep = lam > 1e-4
        self.root = (vec[:, keep] / np.sqrt(lam[keep])).astype(float)

    @staticmethod
    def _sparse(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        coded, starts = symbols(units)
        owner = np.repeat(np.arange(len(units)), [len(u) + 1 + SPAN for u in units])[: len(coded) - SPAN]
        rows, codes, values = [], [], []
        for c, w in zip(OFFSETS, WEIGHTS):
            code = quadruples(coded, c)
            ok = complete(code)
            rows.append(owner[ok])
            codes.append(code[ok])
            values.append(np.full(int(ok.sum()), w, np.float32))
        return np.concatenate(rows), np.concatenate(codes), np.concatenate(values)

    def similar(self, words: list[str]) -> np.ndarray:
        """Kernel values of words and landmarks."""
        out = np.zeros((len(words), len(self.words)), np.float32)
        for k in range(0, len(words), 200):
            units = [core(w) for w in words[k : k + 200]]
            rows, codes, values = self._sparse(units)
            at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            hit = np.flatnonzero(self.codes[at] == codes)
            hit = hit[np.argsort(rows[hit], kind="stable")]
            if hit.size:
                owner, first = np.unique(rows[hit], return_index=True)
                out[k + owner] = np.add.reduceat(values[hit, None] * self.by_code[at[hit]], first, axis=0)
            out[k : k + len(units)] /= norms(np.array([len(u) + 1 for u in units]))[:, None]
        return out

    def vectors(self, words: list[str]) -> np.ndarray:
        return np.hstack((self.similar(words) @ self.root, np.ones((len(words), 1))))

    def machine(self, w: np.ndarray) -> Machine:
        alpha = self.root @ w[:-1]
        return Machine(self.codes, (self.by_code[:-1] @ alpha).astype(np.float32), float(w[-1]), np.zeros(5))


class _Bags:
    """Labelled documents as numbers: the words of all sentences, where sentences begin, and
    the document of each sentence."""

    def __init__(self, texts: list[str]) -> None:
        numbers: dict[str, int] = {}
        ids, starts, owner = array("i"), array("q"), array("q")
        for doc, text in enumerate(texts):
            for words in words_of(text):
                starts.append(len(ids))
                owner.append(doc)
                ids.extend([numbers.setdefault(w, len(numbers)) for w in words])
        self.words = list(numbers)
        self.ids = np.frombuffer(ids, np.int32) if len(ids) else np.zeros(0, np.int32)
        self.starts = np.array(starts, np.int64)
        self.owner = np.array(owner, np.int64)
        self.lengths = np.bincount(self.owner, np.diff(np.append(self.starts, len(self.ids))), len(texts))

    def documents_with(self, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each word, how many clean and how many toxic documents have it."""
        docs = np.repeat(self.owner, np.diff(np.append(self.starts, len(self.ids))))
        pairs = np.unique(self.ids.astype(np.int64) * len(label) + docs)
        word, toxic = pairs // len(label), label[pairs % len(label)] > 0
        return (np.bincount(word[~toxic], minlength=len(self.words)), np.bincount(word[toxic], minlength=len(self.words)))

    def worst(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each sentence, its largest margin and a word that has it."""
        if not len(self.starts):
            return np.zeros(0), np.zeros(0, np.int64)
        each = margins[self.ids]
        top = np.maximum.reduceat(each, self.starts)
        sizes = np.diff(np.append(self.starts, len(self.ids)))
        is_top = np.flatnonzero(each == np.repeat(top, sizes))
        first = is_top[np.searchsorted(is_top, self.starts)]
        return top, self.ids[first]


def train(
    texts: list[str], toxic: list[int], landmarks: int = 192, rounds: int = 3, witnesses: int = 3
) -> Machine | None:
    """A machine from labelled documents; None unless both classes are there."""
    y = np.array(toxic)
    if not (0 < y.sum() < len(y)):
        return None
    bags = _Bags(texts)
    if not bags.words:
        return None
    clean_in, toxic_in = bags.documents_with(y)
    n1, n0 = y.sum(), len(y) - y.sum()
    odds = (np.log((toxic_in + 0.5) / (n1 + 1)) - np.log((clean_in + 0.5) / (n0 + 1))) * np.sqrt(toxic_in)
    long_enough = np.array([len(core(w)) >= ORDER - 1 for w in bags.words])
    by_odds = np.argsort(np.where(long_enough, -odds, np.inf), kind="stable")
    by_count = np.argsort(np.where(long_enough, -clean_in, 1), kind="stable")
    up = [k for k in by_odds[: landmarks // 2] if odds[k] > 0]
    common = [k for k in by_count[:4000] if clean_in[k] > 0 and k not in set(up)]
    marks = _Landmarks([bags.words[k] for k in up + common[: landmarks - len(up)]])

    first = [k for k in up if odds[k] >= odds[up[0]] / 4]
    pairs = {(k, 1): 1 for k in first} | {(k, -1): 1 for k in common}
    for step in range(rounds + 1):
        sign = np.array([side for _, side in pairs], float)
        weight = np.array(list(pairs.values()), float)
        weight[sign > 0] *= weight[sign < 0].sum() / max(1.0, weight[sign > 0].sum())
        x = marks.vectors([bags.words[k] for k, _ in pairs])
        machine = marks.machine(_svm(x, sign, weight, 1.0))
        top, word = bags.worst(machine.margins(bags.words))
        if step == rounds:
            break
        pairs = {(k, -1): 1 for k in common}
        # The sentences of each document, the worst first.
        order = np.lexsort((-top, bags.owner))
        place = np.arange(len(order)) - np.searchsorted(bags.owner[order], bags.owner[order])
        for k, rank in zip(order, place):
            if rank < witnesses:
                label = y[bags.owner[k]]
                # Of a toxic document the worst sentence is positive, and others if they look so.
                if not label or rank == 0 or top[k] > 0:
                    key = (int(word[k]), 1 if label else -1)
                    pairs[key] = pairs.get(key, 0) + 1
    edges = np.searchsorted(bags.owner, np.arange(len(y) + 1))
    features = [
        machine.document_features(top[a:b], n) for a, b, n in zip(edges, edges[1:], bags.lengths)
    ]
    machine.logistic = _logistic(np.array(features), y)
    return machine


def labelled_sample(
    docs: DataFrame, labels: DataFrame, sample: int, id_col: str, text_col: str, label_col: str
) -> DataFrame:
    """``(_text, _label)`` of at most ``sample`` labelled documents, by the least hash of their ids,
    held-out rows apart."""
    known = labels.where(
        F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (bucket(id_col, 4) != 2)
    ).select(F.col(id_col).alias("_id"), (F.col(label_col) > 0).cast("int").alias("_label"))
    chosen = known.groupBy("_id").agg(F.max("_label").alias("_label")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    found = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    known = found.join(F.broadcast(chosen), "_id").orderBy(F.xxhash64("_id"), "_id").limit(sample)
    return known.select("_text", "_label")


def fit(known: DataFrame) -> Machine | None:
    """:func:`train` on a bounded sample, in one task, so that its memory is not the driver's."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[str] = []
        toxic: list[int] = []
        for b in found:
            texts += b.column("_text").to_pylist()
            toxic += b.column("_label").to_pylist()
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(texts, toxic))], pa.binary())], names=["machine"])
        release()

    rows = known.coalesce(1).mapInArrow(run, "machine binary").collect()
    return pickle.loads(bytes(rows[0]["machine"])) if rows else None


def score(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = 6000,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    carry: tuple = ("doc_id",),
) -> DataFrame:
    """``carry`` columns, ``score``, ``worst_sentence`` (its number from 0; null without one) and
    ``predicted``. Documents whose crc32(id) mod 4 is 2 lend no labels."""
    machine = fit(labelled_sample(docs, labels, sample, id_col, text_col, label_col))
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    carried = docs.select(*carry)
    names = carried.columns
    inside = text_col if names == [ROW] else None
    kept = carried if inside else docs.select(*carry, utf8(text_col).alias("_text"))
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema] + ["score double", "worst_sentence int"]
    )

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for whole in found:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                texts = [t.decode("utf-8", "replace") for t in texts_of(b, inside)]
                rows = [machine.score(t) for t in texts] if machine else [(0.0, None)] * len(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(b.column(n) for n in names),
                        pa.array([r[0] for r in rows], pa.float64()),
                        pa.array([r[1] for r in rows], pa.int32()),
                    ],
                    names=[*names, "score", "worst_sentence"],
                )
        if machine:
            machine.forget()
        release()

    return kept.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    found = score(docs, labels, text_col=text_col, carry=(whole_row(docs),), **settings)
    return found.where("predicted = 0").select(f"{ROW}.*")
