"""Language identification: a bidirectional gated recurrent network over bytes.

The network reads a text's bytes, spaces, digits and marks included, forwards and backwards and labels each of them; a
document's log-probabilities are the mean of those of all its bytes. Its state runs on across words. So that a long text
is read in parallel and in bounded memory, it is read in windows of `WINDOW` bytes, all of them, each with `RUN_IN` bytes
on either side that set the state and aren't counted; a text that fits is one window.

Weights come from backpropagation through time in numpy on a bounded sample of labelled rows: for each language the
`SAMPLE_ROWS` rows with the least hashes, and of a longer text `SAMPLE_CHARS` characters from a hashed place on. Every
language that has a labelled row is in the sample, however rare it is.

Edge cases: a text that is null or without a letter (Unicode category L) is `und` with score 0; without a labelled row
everything is; rows are judged one by one, repeated or not; extra columns stay out; ties go to the first language by
name; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import first_by_hash, slices

HIDDEN, WINDOW, RUN_IN = 8, 256, 24
#: The bound of the training sample: rows a language and characters a row.
SAMPLE_ROWS, SAMPLE_CHARS = 400, 4_000
#: Training: steps, windows a step, bytes of a window, and the first rate.
ROUNDS, BATCH, LENGTH, RATE = 400, 160, 56, 0.02
#: Windows that are labelled at once.
AT_ONCE = 1024
UNKNOWN = "und"

#: Bytes as the network sees them: ASCII letters in lower case, digits as one.
FOLD = bytes(b + 32 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))
_ASCII_LETTER = re.compile("[A-Za-z]")

Weights = dict[str, np.ndarray]


def has_letter(text: str) -> bool:
    return _ASCII_LETTER.search(text) is not None or (not text.isascii() and any(map(str.isalpha, text)))


def start_weights(n_languages: int, rng: np.random.Generator) -> Weights:
    w = {}
    for d in "fb":
        w[f"x{d}"] = rng.normal(0, 0.3, (256, 3 * HIDDEN))  # by byte, for update, reset and candidate; biases included
        w[f"u{d}"] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
        w[f"v{d}"] = rng.normal(0, 0.3, (HIDDEN, n_languages))
    return {k: v.astype(np.float32) for k, v in (w | {"c": np.zeros(n_languages)}).items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _step(x: np.ndarray, h: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, ...]:
    """(new state, update, reset, candidate, what the candidate takes from the state)."""
    a = h @ u
    gates = _sigmoid(x[:, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])
    z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
    n = np.tanh(x[:, 2 * HIDDEN :] + r * a[:, 2 * HIDDEN :])
    return n + z * (h - n), z, r, n, a[:, 2 * HIDDEN :]


def _states(w: Weights, d: str, letters: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """The states at each place of letters (places, windows); at place t the first alive[t] windows have a byte. The
    same steps as _step(), in place: labelling a table is nearly all made of them."""
    half, wide = np.float32(0.5), 2 * HIDDEN
    # sigmoid(x) = tanh(x / 2) / 2 + 1 / 2, the first half put into the weights
    (gate_x, new_x), (gate_u, new_u) = ((np.ascontiguousarray(w[k + d][:, :wide]) * half, np.ascontiguousarray(w[k + d][:, wide:])) for k in "xu")
    out = np.zeros((*letters.shape, HIDDEN), np.float32)
    h, gates, drawn = np.zeros((letters.shape[1], HIDDEN), np.float32), np.empty((letters.shape[1], wide), np.float32), np.empty((letters.shape[1], wide), np.float32)
    new, back = np.empty_like(h), np.empty_like(h)
    places = range(len(alive)) if d == "f" else range(len(alive) - 1, -1, -1)
    for t in places:
        n = int(alive[t])
        g, c, a, r, o = gates[:n], new[:n], drawn[:n], back[:n], out[t, :n]
        np.take(gate_x, letters[t, :n], 0, out=g, mode="clip")
        np.take(new_x, letters[t, :n], 0, out=c, mode="clip")
        g += np.matmul(h[:n], gate_u, out=a)
        np.tanh(g, out=g)
        g *= half
        g += half
        np.matmul(h[:n], new_u, out=r)
        r *= g[:, HIDDEN:]
        c += r
        np.tanh(c, out=c)
        np.subtract(h[:n], c, out=o)
        o *= g[:, :HIDDEN]
        o += c
        h[:n] = o
    return out


def _log_softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=-1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=-1, keepdims=True))


def label_sums(w: Weights, windows: list[tuple[bytes, int, int]]) -> np.ndarray:
    """For each (bytes, first, last) the summed log-probabilities of the bytes from first to before last."""
    order = sorted(range(len(windows)), key=lambda k: -len(windows[k][0]))
    lengths = np.array([len(windows[k][0]) for k in order])
    most = int(lengths[0])
    alive = np.searchsorted(-lengths, -np.arange(most), side="left")
    letters = np.frombuffer(b"".join(windows[k][0].ljust(most, b"\0") for k in order), np.uint8).reshape(-1, most)
    letters = np.ascontiguousarray(letters.T).astype(np.intp)
    logits = _states(w, "f", letters, alive) @ w["vf"]
    logits += _states(w, "b", letters, alive) @ w["vb"]
    logits += w["c"]
    place = np.arange(most)[:, None]
    counted = (place >= np.array([windows[k][1] for k in order])) & (place < np.array([windows[k][2] for k in order]))
    by_language = np.ascontiguousarray(logits.transpose(2, 0, 1))
    top = by_language.max(axis=0)
    by_language -= np.log(np.exp(by_language - top).sum(axis=0)) + top
    sums = np.zeros((len(windows), len(by_language)))
    sums[order] = (by_language * counted).sum(axis=1, dtype=np.float64).T
    return sums


def windows_of(text: bytes) -> Iterator[tuple[bytes, int, int]]:
    """(bytes, first, last) of each window: what is read, and the part of it that counts."""
    for s in range(0, len(text), WINDOW):
        e = min(len(text), s + WINDOW)
        low = max(0, s - RUN_IN)
        yield text[low : e + RUN_IN], s - low, e - low


def _back(w: Weights, d: str, letters: np.ndarray, kept: list[tuple], given: np.ndarray, grads: Weights) -> None:
    """Backpropagation through time; given: gradients of the states."""
    dh, by_place = np.zeros_like(given[0]), []
    for t in range(len(kept) - 1, -1, -1):
        h, z, r, n, a = kept[t]
        dh = dh + given[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * a * r * (1 - r)
        by_place.append(np.concatenate([dz, dr, dn], axis=1))
        da = np.concatenate([dz, dr, dn * r], axis=1)
        grads[f"u{d}"] += h.T @ da
        dh = dh * z + da @ w[f"u{d}"].T
    # sums by byte
    dx, at = np.concatenate(by_place[::-1]), letters.T.ravel()
    order = np.argsort(at, kind="stable")
    seen, first = np.unique(at[order], return_index=True)
    grads[f"x{d}"][seen] += np.add.reduceat(dx[order], first, axis=0)


def step_gradients(w: Weights, letters: np.ndarray, target: np.ndarray) -> tuple[float, Weights]:
    """Loss and gradients of the mean negative log-probability of target at all places of letters (windows, places)."""

    def run(d: str, x: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
        h, states, kept = np.zeros((len(x), HIDDEN), w["c"].dtype), [], []
        for t in range(x.shape[1]):
            new, *rest = _step(w[f"x{d}"][x[:, t]], h, w[f"u{d}"])
            kept.append((h, *rest))
            states.append(h := new)
        return np.stack(states), kept

    turned = letters[:, ::-1]
    (forward, kept_f), (backward, kept_b) = run("f", letters), run("b", turned)
    p = np.exp(_log_softmax(forward @ w["vf"] + backward[::-1] @ w["vb"] + w["c"]))
    rows = np.arange(len(target))
    loss = -float(np.log(p[:, rows, target] + 1e-9).mean())
    p[:, rows, target] -= 1
    p /= p.shape[0] * p.shape[1]
    grads = {k: np.zeros_like(v) for k, v in w.items()}
    grads["c"] += p.sum(axis=(0, 1))
    grads["vf"] += np.tensordot(forward, p, ((0, 1), (0, 1)))
    grads["vb"] += np.tensordot(backward[::-1], p, ((0, 1), (0, 1)))
    _back(w, "f", letters, kept_f, p @ w["vf"].T, grads)
    _back(w, "b", turned, kept_b, (p @ w["vb"].T)[::-1], grads)
    return loss, grads


def fit(texts: list[list[bytes]], seed: int = 7) -> Weights:
    """Weights from the folded texts of each language, by Adam on windows that are drawn from all languages alike."""
    rng = np.random.default_rng(seed)
    w = start_weights(len(texts), rng)
    # a language's texts in a row, a blank between them, repeated where they are shorter than a window
    data = []
    for some in texts:
        joined = b" ".join(some)
        data.append(np.frombuffer(joined * (1 + LENGTH // max(1, len(joined))), np.uint8))
    m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    for i in range(1, ROUNDS + 1):
        target = rng.integers(0, len(texts), BATCH)
        starts = [int(rng.integers(0, len(data[k]) - LENGTH + 1)) for k in target]
        letters = np.stack([data[k][s : s + LENGTH] for k, s in zip(target, starts, strict=True)])
        _, grads = step_gradients(w, letters, target)
        rate = RATE * (1 - 0.9 * i / ROUNDS)
        for k, g in grads.items():
            m[k] += 0.1 * (g - m[k])
            v[k] += 0.01 * (g * g - v[k])
            w[k] -= (rate * (m[k] / (1 - 0.9**i)) / (np.sqrt(v[k] / (1 - 0.99**i)) + 1e-6)).astype(np.float32)
    return w


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> dict[str, Any]:
    """{languages, weights} from the bounded sample of rows that aren't held out."""
    usable = docs.filter(~F.coalesce(held_out(F.col(id_col)), F.lit(False)) & F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
    spare = F.greatest(F.length(text_col) - SAMPLE_CHARS, F.lit(0))
    part = F.substr(F.col(text_col), F.pmod(F.xxhash64(text_col), spare + 1).cast("int") + 1, F.lit(SAMPLE_CHARS))
    rows = first_by_hash(usable.select(F.col(id_col).alias("id"), part.alias("text"), F.col(lang_col).alias("lang")), ["id", "text"], SAMPLE_ROWS, by="lang")
    by: dict[str, dict[bytes, None]] = {}
    for r in rows:
        if has_letter(r.text):
            by.setdefault(r.lang, {})[r.text.encode().translate(FOLD)] = None
    languages = sorted(by)
    return {"languages": languages, "weights": fit([list(by[x]) for x in languages]) if languages else {}}


PREDICTION = "lang_pred string, score double"


def predictor(model: dict[str, Any]):
    """text -> struct(lang_pred, score)."""
    languages, weights = model["languages"], model["weights"]

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            for a, b in slices(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), 1 << 22):
                if not weights:
                    break
                some = [(a + k, x.encode().translate(FOLD)) for k, x in enumerate(texts[a:b].to_pylist()) if x is not None and has_letter(x)]
                # all windows of these texts, longest first, so that a block's windows are about as long
                windows = sorted(((row, x) for row, text in some for x in windows_of(text)), key=lambda x: -len(x[1][0]))
                sums = np.zeros((b - a, len(languages)))
                for k in range(0, len(windows), AT_ONCE):
                    block = windows[k : k + AT_ONCE]
                    np.add.at(sums, [row - a for row, _ in block], label_sums(weights, [x for _, x in block]))
                for row, text in some:
                    mean = sums[row - a] / len(text)
                    p = np.exp(mean - mean.max())
                    best = int(p.argmax())
                    names[row], scores[row] = languages[best], float(p[best] / p.sum())
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    predict.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(predict, PREDICTION)


def identify_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row; held-out rows take no part in training."""
    apply = predictor(train(docs, text_col, lang_col, id_col))
    found = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out(F.col(id_col)), F.lit(False)).alias("held_out"), apply(F.col(text_col)).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")
