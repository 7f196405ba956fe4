"""BPE encoding by dynamic programming over prefixes, and decoding.

The BPE encoding of a string is the only sequence of tokens in which every two neighbours are compatible, that is,
stay as they are when their joined bytes are encoded.  So each prefix of a word has one last token.  A suffix
automaton of the vocabulary runs over the word and gives, at each byte, the tokens that end there; the one that is
compatible with the last token of the prefix before it is stored; back-pointers from the end give the ids.

Two tokens are incompatible when a merge crosses their border: a symbol on the right edge of the first and one on
the left edge of the second have a merge that comes before either symbol is merged inside its own token (of equal
merges the left one is done first).

Texts fall into segments (``segments``) and the library's own pre-tokenizer cuts a segment into words; words and
segments are encoded once for each worker while its caches last.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents
from .segments import segments

#: Segments, words and token pairs that a worker remembers; a full cache starts anew.
REMEMBERED = 600_000
NEVER = 1 << 60
#: A word of Latin letters and the marks behind it: every pre-tokenizer cuts these two apart and nothing else.
SIMPLE = re.compile("( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?]*)")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 itself, others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class SuffixAutomaton:
    """All substrings of some byte strings; one state for all strings that end at the same places.

    ``tokens[v]``: (length, number) of the given strings in state v, longest first; ``up[v]``: the next state with
    such strings among the suffixes.
    """

    def __init__(self, strings: dict[int, bytes]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for s in strings.values():
            v = 0
            for c in s:
                v = self.extend(v, c)
        self.tokens: list[tuple] = [()] * len(self.next)
        for number, s in strings.items():
            v = 0
            for c in s:
                v = self.next[v][c]
            self.tokens[v] = tuple(sorted((*self.tokens[v], (len(s), number)), reverse=True))
        self.up = [-1] * len(self.next)
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            u = self.link[v]
            self.up[v] = u if self.tokens[u] else self.up[u]

    def state(self, length: int, link: int, following: dict) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def extend(self, v: int, c: int) -> int:
        """State of the string of state ``v`` (a prefix in hand) followed by ``c``."""
        if c in self.next[v]:
            w = self.next[v][c]
            return w if self.length[w] == self.length[v] + 1 else self.split(v, c, w)
        new, u = self.state(self.length[v] + 1, 0, {}), v
        while u >= 0 and c not in self.next[u]:
            self.next[u][c] = new
            u = self.link[u]
        if u >= 0:
            w = self.next[u][c]
            self.link[new] = w if self.length[w] == self.length[u] + 1 else self.split(u, c, w)
        return new

    def split(self, v: int, c: int, w: int) -> int:
        """The shorter strings of ``w``, up to that of ``v`` with ``c``, get a state of their own."""
        short = self.state(self.length[v] + 1, self.link[w], dict(self.next[w]))
        self.link[w] = short
        while v >= 0 and self.next[v].get(c) == w:
            self.next[v][c] = short
            v = self.link[v]
        return short


class PrefixBPE:
    """A byte-level BPE vocabulary file of the tokenizers library, without its model code."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec["added_tokens"]
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path}: not a plain byte-level BPE")
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
            raise ValueError(f"{path}: added tokens that depend on what stands beside them")
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        letters = byte_letters()
        self.letters = str.maketrans({a: chr(b) for a, b in letters.items()})
        vocab, merges = model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.bytes = {i: t.translate(self.letters).encode("latin-1") for t, i in vocab.items() if set(t) <= letters.keys()}
        self.rank = {(vocab[a], vocab[b]): k for k, (a, b) in enumerate(merges)}
        self.parts = {vocab[a + b]: (vocab[a], vocab[b]) for a, b in merges}
        made = {t: self.rank[p] for t, p in self.parts.items()}
        if len(made) < len(merges) or any(made.get(x, -1) >= k for (a, b), k in self.rank.items() for x in (a, b)):
            raise ValueError(f"{path}: a token is made by two merges, or before its parts")
        #: per token the symbols on its right and left edge over time, each with the merge that ends it
        self.right: dict[int, tuple] = {}
        self.left: dict[int, tuple] = {}
        for t in sorted(self.bytes, key=lambda t: made.get(t, -1)):
            self.right[t] = ((t, NEVER),) + self.edge(t, made, 1, self.right)
            self.left[t] = ((t, NEVER),) + self.edge(t, made, 0, self.left)
        # a token whose own bytes are encoded otherwise never stands anywhere
        self.automaton = SuffixAutomaton({t: s for t, s in self.bytes.items() if len(s) == 1 or t in self.parts and not self.undone(t, made[t])})
        self.added = {a["content"]: a["id"] for a in added}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        self.bytes |= {i: t.encode() for t, i in self.added.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {}  # by the letters of the library's words
        self.simple: dict[str, bytes] = {}  # by the text itself
        self.spaced = Spaced(self)

    def edge(self, t: int, made: dict, side: int, edges: dict) -> tuple:
        """Symbols on one edge inside token ``t``."""
        if t not in self.parts:
            return ()
        part = self.parts[t][side]
        return ((part, made[t]), *edges[part][1:])

    def undone(self, t: int, merge: int) -> bool:
        a, b = self.parts[t]
        return self.crossed(((a, merge), *self.right[a][1:]), ((b, merge), *self.left[b][1:]))

    def crossed(self, rights: tuple, lefts: tuple) -> bool:
        """Whether a merge of a symbol on the right edge with one on the left edge comes before the merges that end them."""
        rank = self.rank
        return any((k := rank.get((x, y), NEVER)) < x_ends and k <= y_ends for x, x_ends in rights for y, y_ends in lefts)

    def compatible(self, a: int, b: int) -> bool:
        """Whether the tokens stay as they are beside each other; the answer is remembered."""
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        answer = self.pairs[a, b] = not self.crossed(self.right[a], self.left[b])
        return answer

    def last_tokens(self, word: bytes) -> list[int]:
        """For each prefix of the word (by its last byte) the last token of its encoding."""
        auto = self.automaton
        follow, link, length, tokens, up = auto.next, auto.link, auto.length, auto.tokens, auto.up
        pairs, compatible = self.pairs, self.compatible
        last: list[int] = []
        v = size = 0
        for i, c in enumerate(word):
            while c not in follow[v]:
                v = link[v]
                size = length[v]
            v = follow[v][c]
            size += 1
            found, u = -1, v
            while found < 0:
                for n, t in tokens[u]:
                    if n > size:
                        continue
                    if n > i:
                        found = t
                        break
                    known = pairs.get((last[i - n], t))
                    if compatible(last[i - n], t) if known is None else known:
                        found = t
                        break
                u = up[u]
            last.append(found)
        return last

    def encode_word(self, word: bytes) -> list[int]:
        last, ids = self.last_tokens(word), []
        i = len(word) - 1
        while i >= 0:
            ids.append(last[i])
            i -= len(self.bytes[last[i]])
        return ids[::-1]

    def encode_segment(self, segment: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if found := SIMPLE.fullmatch(segment):
            word, marks = found.groups()
            out = self.simple.get(word) or self.learn(self.simple, word, word.encode())
            return out + (self.simple.get(marks) or self.learn(self.simple, marks, marks.encode())) if marks else out
        return b"".join([self.words.get(w) or self.learn(self.words, w, w.translate(self.letters).encode("latin-1")) for w, _ in self.cut(segment)])

    def learn(self, known: dict[str, bytes], key: str, word: bytes) -> bytes:
        if len(known) >= REMEMBERED:
            known.clear()
        out = known[key] = b"".join([t.to_bytes(4, "little") for t in self.encode_word(word)])
        return out

    def stretches(self, text: str):
        """Ids of the text in order, as binary stretches."""
        for k, part in enumerate(self.special.split(text) if self.special else [text]):
            if k % 2:
                yield self.added[part].to_bytes(4, "little")
            elif part:
                for n, some in enumerate(segments(part)):
                    if n == 0:
                        yield self.encode_segment(some.pop(0))
                    yield b"".join(map(self.spaced.__getitem__, some))
                    self.spaced.settle()

    def encode(self, text: str) -> list[int]:
        return memoryview(b"".join(self.stretches(text))).cast("I").tolist()

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def decode(self, ids) -> str:
        """Text of any ids; what is not UTF-8 becomes U+FFFD, as in the library."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


class Spaced(dict):
    """Ids of segments, each after its space."""

    def __init__(self, bpe: PrefixBPE):
        self.bpe = bpe

    def __missing__(self, segment: str) -> bytes:
        out = self[segment] = self.bpe.encode_segment(" " + segment)
        return out

    def settle(self) -> None:
        if len(self) > REMEMBERED:
            self.clear()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> PrefixBPE:
    """One for each worker process and file."""
    return PrefixBPE(path)


def roundtrip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode every text and decode its ids again, in one pass over the rows without a shuffle.

    One row per input row: ``doc_id``, ``n_tokens``, ``ids_sha256`` (ids as little-endian unsigned 32-bit integers),
    ``decoded_sha256`` (decoded text in UTF-8), and with ``with_ids`` also ``ids`` (array of int) and ``decoded``.
    Strings of added tokens in a text become those tokens, as the library does by default.  Null and empty texts have
    no ids.  Repeated rows and null ids give a row each; extra columns are left out; very long texts are encoded and
    hashed in stretches.  An empty table gives no rows.  The file must be at ``path`` on every worker.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    more = [("ids", pa.list_(pa.int32())), ("decoded", pa.string())] if with_ids else []

    def run(batches):
        bpe = vocabulary(path)
        for b in batches:
            out = [[] for _ in fields + more]
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"], strict=True):
                n, ids_hash, text_hash, ids, raw = 0, hashlib.sha256(), hashlib.sha256(), [], []
                for stretch in bpe.stretches(text.as_py()):
                    some = memoryview(stretch).cast("I").tolist()
                    decoded = bpe.decode_bytes(some)
                    ids_hash.update(stretch)
                    text_hash.update(decoded)
                    n += len(some)
                    if with_ids:
                        ids += some
                        raw.append(decoded)
                row = [doc_id, n, ids_hash.hexdigest(), text_hash.hexdigest()]
                for column, value in zip(out, row + [ids, b"".join(raw).decode("utf-8", "replace")], strict=False):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(out, fields + more, strict=True)], names=[n for n, _ in fields + more])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")
    return documents(docs, id_col, text_col).select("doc_id", "text").mapInArrow(run, schema)
