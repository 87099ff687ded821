"""Byte-level BPE by prefix-sharing trie traversal.

The words of a block of texts are made distinct and laid out as a trie:
sorted byte strings are the trie's paths in depth-first order, and the
common prefix with the previous word is the path back to the branching
node.  Each node carries one state, the last token of the encoding of the
bytes above it; the encoding of a prefix is that of the prefix without its
last token, then this token, so a node's state follows from states further
up and the encodings of shared prefixes are computed once.  The last token
at a node is the one vocabulary entry ending there that BPE leaves beside
the state before it (tested by undoing the merges of both, and
remembered).

The texts' words come from the tokenizer's own split pattern; the special
token's string is taken out of the text first, as the tokenizer does.

Defined results: null texts count as empty and give no ids; any length of
text or word is encoded whole; repeated rows give equal rows; an empty
table gives an empty one; further columns are not read unless kept.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm.common import ready

#: White_Space of Unicode, as the tokenizer's split pattern has it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The tokenizer's split pattern.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|["
         + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")
#: Texts are worked through in blocks of about so many characters, and the
#: words remembered between blocks take about so many bytes at most.
BLOCK_CHARS, MEMO_BYTES, MEMO_PAIRS = 1_000_000, 48_000_000, 200_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable
    Latin-1 stands for itself, the rest for U+0100 onwards."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


def token_bytes(spec: dict) -> list[bytes]:
    """The bytes that each id stands for."""
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocab = spec["model"]["vocab"]
    out = [b""] * (1 + max([*vocab.values(), *special.values()]))
    for name, i in vocab.items():
        out[i] = bytes(letters[c] for c in name) if name not in special else name.encode()
    for name, i in special.items():
        out[i] = name.encode()
    return out


class Vocabulary:
    """Tokens, merges and special tokens of a tokenizer file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = token_bytes(spec)
        self.token = {self.bytes_of[i]: i for name, i in spec["model"]["vocab"].items() if name not in self.special}
        self.four = [i.to_bytes(4, "little") for i in range(len(self.bytes_of))]
        self.size = list(map(len, self.bytes_of))
        names = spec["model"]["vocab"]
        self.merge: dict[int, tuple[int, int]] = {}  # pair → its rank and the token it makes
        self.rank = [-1] * len(self.bytes_of)  # of the merge that makes a token; -1: a byte
        self.halves: list[tuple[int, int]] = [(0, 0)] * len(self.bytes_of)
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            made = names[a + b]
            self.merge[names[a] << 20 | names[b]] = (rank, made)
            self.rank[made], self.halves[made] = rank, (names[a], names[b])
        #: Every ending of a token, with the token that it is itself (-1: none).
        self.ending = dict.fromkeys((data[k:] for data in self.token for k in range(len(data))), -1)
        self.ending.update(self.token)
        self.single = [self.token[bytes([b])] for b in range(256)]


class TrieEncoder:
    """Encodings of words, with what is worth remembering between calls."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.beside: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.follow: dict[int, int] = {}

    def merged(self, data: bytes) -> list[int]:
        """Plain BPE of a short byte string."""
        ids, merge = [self.v.single[b] for b in data], self.v.merge
        while len(ids) > 1:
            best = min((merge[a << 20 | b] + (k,) for k, (a, b) in enumerate(zip(ids, ids[1:]))
                        if a << 20 | b in merge), key=lambda m: (m[0], m[2]), default=None)
            if best is None:
                break
            ids[best[2]:best[2] + 2] = [best[1]]
        return ids

    def stays(self, a: int, b: int) -> bool:
        """Does BPE leave token b right after token a?  The merges of both are
        undone from the last to the first; at each moment the two tokens that
        met at the border must have had no merge due before the one that was
        undone (of equal merges the left one comes first)."""
        key = a << 20 | b
        known = self.beside.get(key)
        if known is None:
            merge, rank, halves = self.v.merge, self.v.rank, self.v.halves
            due, known = 1 << 40, True
            while True:
                met = merge.get(a << 20 | b)
                if met is not None and 2 * met[0] < due:
                    known = False
                    break
                made_a, made_b = rank[a], rank[b]
                if made_b >= made_a:
                    if made_b < 0:
                        break
                    due, b = 2 * made_b + 1, halves[b][0]
                else:
                    due, a = 2 * made_a, halves[a][1]
            if len(self.beside) >= MEMO_PAIRS:
                self.beside.clear()
            self.beside[key] = known
        return known

    def alone(self, t: int) -> bool:
        """Is token t its own encoding?"""
        known = self.whole.get(t)
        if known is None:
            known = self.whole[t] = self.merged(self.v.bytes_of[t]) == [t]
        return known

    def encode(self, words: set[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """(word, packed ids) of each word, in the depth-first order of their trie.  The state
        that followed a state and a byte before is tried first: if it is no longer than
        both, its bytes are theirs, and only its neighbour must allow it."""
        ending, four, size = self.v.ending.get, self.v.four, self.v.size
        beside, stays, follow = self.beside.get, self.stays, self.follow
        guess = follow.get
        if len(follow) >= MEMO_PAIRS:
            follow.clear()
        last: list[int] = []  # states on the path from the root to the current node
        before = b""
        for word in sorted(words):
            depth, most = 0, min(len(before), len(word))
            while depth < most and before[depth] == word[depth]:
                depth += 1
            del last[depth:]
            state = last[-1] if depth else -1
            for end in range(depth + 1, len(word) + 1):
                key = state << 8 | word[end - 1]
                t = guess(key)
                if t is not None:
                    start = end - size[t]
                    if (beside(last[start - 1] << 20 | t) if start else self.alone(t)):
                        last.append(t)
                        state = t
                        continue
                start, found = end - 1, -1
                t = ending(word[start:end])
                while t is not None:  # at most as far back as some token reaches
                    if t >= 0:
                        if start:
                            a = last[start - 1]
                            good = beside(a << 20 | t)
                            if good is None:
                                good = stays(a, t)
                        else:
                            good = self.alone(t)
                        if good:
                            found = t
                            break
                    start -= 1
                    t = ending(word[start:end]) if start >= 0 else None
                last.append(found)
                if state >= 0 and size[found] <= size[state] + 1:
                    follow[key] = found
                state = found
            before, ids, end = word, [], len(word)
            while end:
                t = last[end - 1]
                ids.append(four[t])
                end -= size[t]
            ids.reverse()
            yield word, b"".join(ids)


class TextEncoder:
    """Packed ids (little-endian unsigned 32-bit) of whole texts.

    A text is first cut before its spaces, which is where the split pattern
    cuts too unless a space stands between other white space; only pieces not
    met before go through the pattern and the trie."""

    def __init__(self, vocabulary: Vocabulary):
        self.trie = TrieEncoder(vocabulary)
        self.find = regex.compile(SPLIT).findall
        self.within_space = regex.compile(f"[{SPACE}] (?:[{SPACE}]|$)").search
        self.special = {s: int(i).to_bytes(4, "little") for s, i in vocabulary.special.items()}
        names = sorted(self.special, key=len, reverse=True)
        self.parts = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None
        # a space and this piece → packed ids; what was met since the last turn, and in the turn before
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """All texts of a block at once: one trie over its new words."""
        todo: list[tuple[int, str]] = []  # (text, part)
        for k, text in enumerate(texts):
            if self.parts is not None and any(s in text for s in self.special):
                todo += [(k, part) for part in self.parts(text)]
            else:
                todo.append((k, text))
        # each part: words found by the pattern (its head, or all of it), then pieces
        split = []
        for k, part in todo:
            if part in self.special:
                split.append((k, part, ()))
            elif self.within_space(part):
                split.append((k, self.find(part), ()))
            else:
                head, *pieces = part.split(" ")
                split.append((k, self.find(head), pieces))
        if 2 * self.held > MEMO_BYTES:  # frequent pieces are met again before they are forgotten
            self.memo, self.older, self.held = {}, self.memo, 0
        memo, older = self.memo, self.older
        single, several = [], {}  # new pieces: those of letters are a word, others go through the pattern
        for piece in set().union(*[s[2] for s in split]) - memo.keys():
            code = older.get(piece)
            if code is not None:
                memo[piece] = code
                self.held += 200 + len(piece) + len(code)
            elif piece.isalpha():
                single.append(piece)
            else:
                several[piece] = self.find(" " + piece)
        ids: dict[str, bytes] = {}
        words = {" " + piece for piece in single}
        for word in set().union(*several.values(), *[s[1] for s in split if isinstance(s[1], list)]):
            code = (memo.get(word[1:]) or older.get(word[1:])) if word[0] == " " else None
            if code is None:
                words.add(word)
            else:
                ids[word] = code
        ids.update((word.decode(), code) for word, code in self.trie.encode({w.encode() for w in words}))
        for piece in single:
            memo[piece] = code = ids[" " + piece]
            self.held += 200 + len(piece) + len(code)
        for piece, found in several.items():
            memo[piece] = code = b"".join([ids[w] for w in found])
            self.held += 200 + len(piece) + len(code)
        out: list[list[bytes]] = [[] for _ in texts]
        for k, head, pieces in split:
            if isinstance(head, str):
                out[k].append(self.special[head])
            else:
                out[k] += [ids[w] for w in head]
                out[k] += map(memo.__getitem__, pieces)
        return [b"".join(x) for x in out]


@functools.lru_cache(maxsize=2)
def _encoder(spec: str) -> TextEncoder:
    """One per worker process: what it remembers serves later tasks too."""
    return TextEncoder(Vocabulary(spec))


@functools.lru_cache(maxsize=2)
def _pieces(spec: str) -> list[bytes]:
    return token_bytes(json.loads(spec))


def _encoded(encoder: TextEncoder, batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], list[pa.Array]]]:
    """(packed ids, other columns) of each block of a batch whose last column is the text."""
    at = 0
    for block in _blocks(batch.column(batch.num_columns - 1)):
        yield encoder.encode(block), [c.slice(at, len(block)) for c in batch.columns[:-1]]
        at += len(block)


def _blocks(texts: pa.Array) -> Iterator[list[str]]:
    block, size = [], 0
    for t in texts:
        t = t.as_py() or ""
        block.append(t)
        size += len(t)
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)
           ) -> DataFrame:
    """The ``keep`` columns, n_tokens, and ids packed as little-endian
    unsigned 32-bit integers.  ``path`` names the tokenizer file; the driver
    reads it and broadcasts its text (a file of fixed size)."""
    spark = ready(docs)
    spec = spark.sparkContext.broadcast(read_vocabulary(path))
    fields = [docs.schema[c] for c in keep]
    out = T.StructType([*fields, T.StructField("n_tokens", T.LongType()),
                        T.StructField("ids", T.BinaryType())])

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(spec.value)
        for batch in batches:
            for ids, kept in _encoded(encoder, batch):
                yield pa.record_batch([*kept, pa.array([len(x) // 4 for x in ids], pa.int64()),
                                       pa.array(ids, pa.binary())], names=out.names)

    return docs.select(*[F.col(c) for c in keep], F.col(text_col).cast("string").alias("text_")
                       ).mapInArrow(ids_of, out)


def decode(encoded: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id", "n_tokens", "ids")
           ) -> DataFrame:
    """The ``keep`` columns and the decoded text of the packed ``ids``
    (null: empty); bytes that are no UTF-8 become U+FFFD."""
    spark = ready(encoded)
    spec = spark.sparkContext.broadcast(read_vocabulary(path))
    out = T.StructType([*[encoded.schema[c] for c in keep], T.StructField("decoded", T.StringType())])

    def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = _pieces(spec.value).__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [b"".join(map(piece, np.frombuffer(x or b"", "<u4").tolist()))
                         .decode("utf-8", "replace") for x in part.column(len(keep)).to_pylist()]
                yield pa.record_batch([*part.columns[:len(keep)], pa.array(texts, pa.string())],
                                      names=out.names)

    return encoded.select(*[F.col(c) for c in keep], F.col("ids").alias("ids_")).mapInArrow(texts_of, out)


def digests(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text: encoded and
    decoded block by block in one worker, as encode() and decode() do, so that
    neither ids nor decoded texts leave it."""
    spark = ready(docs)
    spec = spark.sparkContext.broadcast(read_vocabulary(path))
    out = T.StructType([docs.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(spec.value)
        piece = encoder.trie.v.bytes_of.__getitem__
        for batch in batches:
            for ids, (doc_id,) in _encoded(encoder, batch):
                texts = (b"".join(map(piece, np.frombuffer(x, "<u4").tolist())).decode("utf-8", "replace") for x in ids)
                yield pa.record_batch([
                    doc_id, pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())], names=out.names)

    return docs.select("doc_id", F.col(text_col).cast("string").alias("text_")).mapInArrow(both, out)
