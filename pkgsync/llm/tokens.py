"""Token ids of texts by the ``tokenizers`` library, each distinct word encoded once.

Strings of special tokens within a text become those tokens, as the library has it; such texts go to it whole.
A byte-level BPE with the usual split pattern never merges across a single space that stands between two
characters that aren't white space: the space opens the next match.  So a text falls into words there, and the ids
of a text are the ids of its words, each with its space.  The words of a batch are dictionary-encoded by Arrow, the
library encodes the new ones in long runs, whose ids fall apart again at the tokens that begin with a space, and
numpy lays out the ids.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text of this many characters is laid out at a time; words that go to the library at a time.
STEP, RUN = 24_000_000, 20_000


def plain(text: str) -> bool:
    """Whether all white space of the text is single spaces or line ends, no space beside either or at an end.

    ``isprintable`` is false for every other character that ``\\s`` of any regex library takes for white space.
    """
    return (bool(text) and text.replace("\n", "").isprintable() and "  " not in text and " \n" not in text
            and "\n " not in text and text[0] != " " and text[-1] != " ")


class WordEncoder:
    """Unsigned 32-bit ids of texts; the cache holds at most ``most`` words besides a batch's own."""

    def __init__(self, path: str, most: int = 1_500_000):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.spaced_added = any(" " in a for a in self.added)  # words side by side could make one
        self.tok.no_padding()
        self.tok.no_truncation()
        self.size, self.most = self.tok.get_vocab_size(), most
        # the vocabulary shows a space as U+0120
        self.spaced = np.array([(self.tok.id_to_token(i) or "")[:1] == "\u0120" for i in range(self.size)])
        self.forget()

    def forget(self) -> None:
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes() if text else b""

    def spelt(self, words: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of distinct words, each after a space."""
        if len(self.words) > self.most:
            self.forget()
        at = pc.index_in(words, value_set=self.words)
        unknown = at.is_null()
        new = words.filter(unknown)
        places = at.fill_null(0).to_numpy().astype(np.int64)
        places[unknown.to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(len(new))
        self.words, self.ids = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.ids, self.learn(new)])
        return self.ids.take(pa.array(places))

    def learn(self, words: pa.LargeStringArray) -> pa.LargeBinaryArray:
        runs = [" " + " ".join(words.slice(s, RUN).to_pylist()) for s in range(0, len(words), RUN)]
        ids = np.concatenate([np.empty(0, "<u4"), *(np.frombuffer(self.whole(r), "<u4") for r in runs)])
        return binaries(ids, np.append(np.flatnonzero(self.spaced[ids]), len(ids)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        batch, size = [], 0
        for i, t in enumerate(texts):
            if plain(t) and not self.spaced_added and not any(a in t for a in self.added):
                batch.append(i)
                size += len(t)
                if size > STEP:
                    self.encode_plain(texts, batch, out)
                    batch, size = [], 0
            else:
                out[i] = np.frombuffer(self.whole(t), "<u4")
        if batch:
            self.encode_plain(texts, batch, out)
        return out

    def encode_plain(self, texts: list[str], at: list[int], out: list) -> None:
        words = pc.split_pattern(pa.array([texts[i] for i in at], pa.large_string()), " ")
        bounds = np.concatenate([[0], np.cumsum(words.value_lengths().to_numpy())]).astype(np.int64)
        coded = words.flatten().dictionary_encode()
        each, codes = coded.dictionary, coded.indices.to_numpy().copy()
        del words, coded
        # a text's first word has no space before it
        firsts = [self.whole(texts[i].partition(" ")[0]) for i in at]
        codes[bounds[:-1]] = len(each) + np.arange(len(at))
        laid = pa.concat_arrays([self.spelt(each), pa.array(firsts, pa.large_binary())]).take(pa.array(codes))
        _, offsets, values = laid.buffers()
        flat, cuts = np.frombuffer(values, "<u4"), np.frombuffer(offsets, np.int64)[bounds] >> 2
        for j, i in enumerate(at):
            out[i] = flat[cuts[j]:cuts[j + 1]]


def binaries(ids: np.ndarray, starts: np.ndarray) -> pa.LargeBinaryArray:
    """Ids as one binary value from each start to the next."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64) * 4), pa.py_buffer(ids)])


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process and vocabulary file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task its core
    return WordEncoder(path)
