"""Language of texts and of spans in them: scripts, scores per word, Viterbi with a switching penalty."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleaner.llm.hashing import over, pieces, texts_of

CELLS = 1 << 16           # hashed byte trigrams
SMOOTH = 0.1
PENALTY = 12.0            # cost of another language than the word before, in nats
LEAST_SHARE = 0.001       # of a language's words that must be in a script for it to be a candidate there
GROUP_BYTES = 4 << 20     # text that goes through Viterbi at a time

# First code points of Unicode ranges, with the script that begins there.
RANGES = [
    (0x0000, "Latin"), (0x0250, "Other"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "Other"), (0x0750, "Arabic"), (0x0780, "Other"),
    (0x08A0, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"),
    (0x0B00, "Odia"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"), (0x1780, "Khmer"),
    (0x1800, "Mongolian"), (0x18B0, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"),
    (0x3040, "Kana"), (0x3100, "Other"), (0x3400, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"),
    (0xF900, "Han"), (0xFB00, "Other"), (0x20000, "Han"), (0x323B0, "Other"),
]
SCRIPTS = sorted({name for _, name in RANGES})
_STARTS = np.array([at for at, _ in RANGES])
_NAMES = np.array([SCRIPTS.index(name) for _, name in RANGES])


def _cells(buf: np.ndarray):
    """Trigram cell of each letter byte, its script by word, and the words' first and end bytes."""
    letter = ((buf >= 97) & (buf <= 122)) | ((buf >= 65) & (buf <= 90)) | (buf >= 128)
    fold = ((buf >= 65) & (buf <= 90)) & letter
    fold[1:] |= (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)
    y = np.zeros(len(buf) + 2, dtype=np.uint32)
    y[1:-1] = np.where(letter, buf + fold.view(np.uint8) * np.uint8(32), 0)
    key = (y[:-2] << np.uint32(16)) | (y[1:-1] << np.uint32(8)) | y[2:]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], letter, [False])).view(np.int8)))
    start, end = edges[0::2], edges[1::2]
    cells = ((key[letter] * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)
    more = np.concatenate((buf, np.zeros(3, dtype=np.uint8))).astype(np.int64)
    b0, b1, b2, b3 = (more[start + k] for k in range(4))
    code = np.where(b0 < 0xC0, b0, np.where(b0 < 0xE0, (b0 & 31) << 6 | b1 & 63, np.where(
        b0 < 0xF0, (b0 & 15) << 12 | (b1 & 63) << 6 | b2 & 63,
        (b0 & 7) << 18 | (b1 & 63) << 12 | (b2 & 63) << 6 | b3 & 63)))
    return cells, _NAMES[np.searchsorted(_STARTS, code, side="right") - 1], start, end


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray     # cell x language: log probability
    allowed: np.ndarray    # script x language: candidates of a script


def _count(batches):
    """Cells and scripts by language, summed over a task: at most ``CELLS`` rows per language."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            if lang not in totals:
                totals[lang] = np.zeros(CELLS + len(SCRIPTS), dtype=np.int64)
            for _, piece in pieces(text):
                cells, script, _, _ = _cells(np.frombuffer(piece, dtype=np.uint8))
                np.add.at(totals[lang], cells, 1)
                totals[lang][CELLS:] += np.bincount(script, minlength=len(SCRIPTS))
    for lang, counts in totals.items():
        cell = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cell), pa.string()), pa.array(cell),
                                          pa.array(counts[cell])], ["lang", "cell", "n"])


def train(docs: DataFrame) -> Model:
    """Counts over all rows of ``docs(lang, text)`` with both; what reaches the driver is one table per language."""
    counted = (docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
               .mapInArrow(_count, "lang string, cell bigint, n bigint")
               .groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow().to_pandas())
    langs = sorted(counted["lang"].unique())
    counts = np.zeros((CELLS + len(SCRIPTS), len(langs)))
    counts[counted["cell"], counted["lang"].map({x: k for k, x in enumerate(langs)})] = counted["n"]
    cells, scripts = counts[:CELLS], counts[CELLS:]
    share = scripts / np.maximum(scripts.sum(axis=0), 1)
    allowed = share >= LEAST_SHARE
    allowed[~allowed.any(axis=1)] = True
    return Model(langs, np.log((cells + SMOOTH) / (cells.sum(axis=0) + SMOOTH * CELLS)).astype(np.float32), allowed)


def word_scores(model: Model, texts: list[bytes]):
    def run(buf):
        cells, script, start, end = _cells(buf)
        if not len(start):
            return np.zeros((0, len(model.langs)), dtype=np.float32), start, end
        length = end - start
        score = np.add.reduceat(model.scores[cells], np.cumsum(length) - length, axis=0)
        score[~model.allowed[script]] = -1e30
        return score, start, end
    return over(texts, run)


def viterbi(scores: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """Best label of each word of each text; texts step together, so a step is one array operation."""
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    lengths = np.array([len(scores[i]) for i in order])
    if not len(lengths) or not lengths[0]:
        return [np.zeros(0, dtype=np.int64) for _ in scores]
    flat, first = np.concatenate([scores[i] for i in order]), np.cumsum(lengths) - lengths
    kinds = np.arange(flat.shape[1])
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")   # texts longer than t
    back = np.empty(flat.shape, dtype=np.int16)
    best = flat[first[:active[0]]].astype(np.float64)
    final = np.zeros(len(lengths), dtype=np.int64)
    for t in range(1, lengths[0]):
        n = active[t]
        if n < len(best):
            final[n:len(best)] = best[n:].argmax(axis=1)
            best = best[:n]
        at = first[:n] + t
        top = best.argmax(axis=1)
        jump = best[np.arange(n), top] - penalty
        stay = best >= jump[:, None]
        back[at] = np.where(stay, kinds, top[:, None])
        best = np.where(stay, best, jump[:, None]) + flat[at]
    final[:len(best)] = best.argmax(axis=1)
    labels, state = np.empty(len(flat), dtype=np.int64), final.copy()
    for t in range(lengths[0] - 1, -1, -1):
        n = active[t]
        at = first[:n] + t
        labels[at] = state[:n]
        if t:
            state[:n] = back[at, state[:n]]
    out: list = [None] * len(scores)
    for k, i in enumerate(order):
        out[i] = labels[first[k]:first[k] + lengths[k]]
    return out


def _spans(labels, start, end, langs):
    if not len(labels):
        return []
    cut = np.concatenate(([0], np.flatnonzero(np.diff(labels)) + 1, [len(labels)]))
    return [{"start": int(start[a]), "end": int(end[b - 1]), "lang": langs[labels[a]]} for a, b in zip(cut, cut[1:])]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


def _label(model: Model, penalty: float):
    def group(texts, letters):
        found = list(word_scores(model, texts))
        for (_, start, end), labels, has in zip(found, viterbi([f[0] for f in found], penalty), letters):
            if not has or not len(labels):
                yield "und", 0.0, []
                continue
            weight = np.bincount(labels, weights=end - start, minlength=len(model.langs))
            top = int(weight.argmax())
            yield model.langs[top], float(weight[top] / weight.sum()), _spans(labels, start, end, model.langs)

    def run(batches):
        for batch in batches:
            texts, letters = texts_of(batch.column(1)), batch.column(2).to_pylist()
            rows, at = [], 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) <= GROUP_BYTES):
                    size += len(texts[to])
                    to += 1
                rows += (group(texts[at:to], letters[at:to]) if model.langs else [("und", 0.0, [])] * (to - at))
                at = to
            lang, score, spans = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(spans, _SPANS)], ["doc_id", "lang_pred", "score", "spans"])
    return run


def identify(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """``doc_id, lang_pred, score, spans``: one row per row of ``docs(doc_id, text, ...)``.

    ``spans`` are runs of words of one language with their bytes in the text;
    ``lang_pred`` is the language of most letters (of equal ones the first by
    name) and ``score`` its share of them. A null text, one without a letter,
    or a model without languages gives ``und``, 0 and no span. Other columns,
    a language among them, are ignored.
    """
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", letters.alias("letters"))
            .mapInArrow(_label(model, penalty), "doc_id bigint, lang_pred string, score double, "
                        "spans array<struct<start: bigint, end: bigint, lang: string>>"))


def held_out(doc_id="doc_id"):
    """Whether a document is outside of the fitted ones: every fifth by CRC-32 of its id as text; no id: no."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0, F.lit(False))
