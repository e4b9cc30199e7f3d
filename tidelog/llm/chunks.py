"""Texts cut where a tokenizer cuts anyway, so that it sees each distinct chunk of many texts once."""

from __future__ import annotations

import os
import string
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Chunks whose tokens a worker remembers from one batch to the next; results don't depend on it.
MOST_KNOWN = 800_000


#: Letters that every library composes, lowers and counts as letters alike (fixed values).
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN_BYTE, _LATIN_BYTE = (np.array([chr(b) in found for b in range(256)]) for found in (set(string.ascii_letters + string.digits), {chr(b) for b in range(0x80, 0xC0)} - {chr(0x97), chr(0xB7)}))


def after_letters(b: np.ndarray) -> np.ndarray:
    """For each byte whether it comes after an ASCII letter or digit, or one of the other LETTERS."""
    out = np.zeros(len(b), bool)
    out[1:] = _PLAIN_BYTE[b[:-1]]
    out[2:] |= (b[:-2] == 0xC3) & _LATIN_BYTE[b[1:-1]]
    return out


def byte_alphabet() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Words:
    """The ids of single words, from the tokenizer's BPE model itself: what comes before it wouldn't change or cut them."""

    def __init__(self, tokenizer: Tokenizer):
        self.model, self.letters = tokenizer.model, {b: c for c, b in byte_alphabet().items()}

    def __call__(self, word: str) -> list[int]:
        return [x.id for x in self.model.tokenize("".join([self.letters[b] for b in word.encode()]))]


@cache
def load_tokenizer(path: str, plain_specials: bool) -> Tokenizer:
    """plain_specials: strings of special tokens in texts are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
    found = Tokenizer.from_file(path)
    found.encode_special_tokens = plain_specials
    return found


def slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose strings have at most most_bytes, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    ends, begin = np.cumsum(sizes, dtype=np.int64), 0
    while begin < batch.num_rows:
        before = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most_bytes, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


class Chunked:
    """The chunks of some texts: which distinct chunk each is, and where each text's begin.

    cut tells for each byte of the texts laid end to end (each after lead) whether a chunk begins there; texts begin one
    anyway. A null text is an empty one; an empty one without lead has no chunks.
    """

    def __init__(self, texts: pa.Array, cut: Callable[[np.ndarray], np.ndarray], lead: str = ""):
        texts = texts.fill_null("")
        if lead:
            texts = pc.binary_join_element_wise("", texts, lead)
        self.bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        low, high = int(self.bounds[0]), int(self.bounds[-1])
        if low == high:
            self.index, self.distinct, self.sizes, self.first = np.zeros(0, np.int32), pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
            return
        data = np.frombuffer(texts.buffers()[2], np.uint8)[low:high]
        begins = cut(data)
        begins[(self.bounds[:-1] - low)[self.bounds[:-1] < high]] = True
        starts = np.append(np.flatnonzero(begins) + low, high).astype(np.int32)
        del begins
        coded = pa.Array.from_buffers(pa.string(), len(starts) - 1, [None, pa.py_buffer(starts), texts.buffers()[2]]).dictionary_encode()
        self.index, self.distinct = coded.indices.to_numpy(), coded.dictionary
        self.sizes = np.diff(starts)
        self.first = np.searchsorted(starts, self.bounds)


class Remembered:
    """A function of strings, asked for many at once; answers are kept for the next time.

    Two generations of at most `most` / 2 answers (and one call's) each: what is asked for again moves to the younger,
    and when that is full the older one goes.
    """

    def __init__(self, ask: Callable[[list[str]], list], most: int = MOST_KNOWN):
        self.ask, self.most, self.young, self.old = ask, most, {}, {}

    def __call__(self, keys: list[str]) -> list:
        if len(self.young) > self.most // 2:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        absent = [k for k in keys if k not in young]
        new = []
        for k in absent:
            if (found := old.get(k)) is None:
                new.append(k)
            else:
                young[k] = found
        young.update(zip(new, self.ask(new), strict=True))
        return [young[k] for k in keys]


def packed(found: list[list[int]]) -> list[bytes]:
    """Lists of ids as 32-bit integers each."""
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    data = np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum())).tobytes()
    ends = (4 * np.cumsum(lengths)).tolist()
    return [data[i:j] for i, j in zip([0, *ends], ends, strict=False)]


def lists(values: list[bytes]) -> pa.ListArray:
    """Packed 32-bit integers as lists."""
    ends = np.cumsum([0] + [len(v) // 4 for v in values]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(values), np.int32)))
