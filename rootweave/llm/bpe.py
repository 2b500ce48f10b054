"""Byte-level BPE encoding and decoding.

Encoding. Text is cut by the tokenizer's pattern and each piece goes through a finite-state
transducer that is built from the ranks as it is used. Any token may start at any byte, which is a
nondeterministic automaton; its subsets of started tokens are made states when first met (lazy
determinisation). A state tells which tokens end with the last byte. Exactly one of them is the
last token of the encoding of the bytes so far: the one that stays apart from the token before its
start when these two alone are merged, because a sequence of tokens is an encoding if and only if
that holds for all neighbours. So each prefix has one history, and what the histories of the last
bytes have in common can never change. No token is longer than the lookahead, hence tokens before
the point where those histories meet are emitted while the piece is still being read.

Decoding. Token bytes go through a UTF-8 state machine that holds back an incomplete character
until its last byte arrives. Whole characters pass at once; ill-formed bytes give U+FFFD.

Both are row-wise Arrow functions: no shuffle, memory bounded by the caches and one batch.

Defined cases: null text is empty text; empty text has no tokens; existing columns with the names
of the results are replaced, all others pass through; rows are never dropped or merged.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootweave.llm.common import begin, end, kept, small_batches

# Entries kept per Python worker before a cache starts anew; results do not depend on them.
MEMO = 80_000
PAIRS = 200_000
END = 1 << 40  # later than every rank

# In these characters the standard library's classes agree with Unicode's; others take the slow path.
_UNUSUAL = re.compile("[^\x00-\x1b\x20-\x7f\xc0-\xd6\xd8-\xf6\xf8-ɏ]")
_CONTROL = re.compile("[\x1c-\x1f]")


def read_ranks(spark: SparkSession, path: str) -> bytes:
    """The rank file (base64 token, rank in each line), read on the driver; vocabularies are small."""
    if "://" not in path:
        with open(path, "rb") as file:
            return file.read()
    row = spark.read.format("binaryFile").load(path).select("content").first()
    return bytes(row[0])


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}


class Transducer:
    """Bytes of one piece in, token ids out."""

    ROOT = 0

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.lookahead = max(map(len, ranks), default=1)
        self.children: dict[int, int] = {}
        self.whole: dict[int, tuple[int, int]] = {}
        nodes = 1
        for token, rank in ranks.items():
            node = self.ROOT
            for byte in token:
                key = node << 8 | byte
                node = self.children.get(key) or self.children.setdefault(key, nodes)
                nodes = max(nodes, node + 1)
            self.whole[node] = rank, len(token)
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        # By token, whether it stays apart from the token on its left.
        self.apart: dict[int, dict[int, bool]] = {}
        self.pairs = 0
        self.edge: dict[int, tuple[list, list]] = {}
        # A state is the set of started tokens, longest first; its output the tokens that end there.
        self.states: list[tuple[int, ...]] = [(self.ROOT,)]
        self.number = {self.states[0]: 0}
        self.ending: list[list[tuple[int, int, dict[int, bool]]]] = [[]]
        self.moves: dict[int, int] = {}

    def merge(self, piece: bytes, until: int = 1) -> list[bytes]:
        """Plain merging by rank down to ``until`` parts; only for single tokens."""
        rank, none = self.ranks.get, len(self.ranks) + 256
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > until:
            best, at = min((rank(a + b, none), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == none:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edges(self, token: int) -> tuple[list, list]:
        """What touches the left and the right end of ``token`` while it is merged, and the rank that ends it."""
        found = self.edge.get(token)
        if found is None:
            piece = self.tokens[token]
            left, right = [(piece, END)], [(piece, END)]
            if len(piece) > 1:
                first, last = self.merge(piece, 2)
                left += [(part, min(end, token)) for part, end in self.edges(self.ranks[first])[0]]
                right += [(part, min(end, token)) for part, end in self.edges(self.ranks[last])[1]]
            found = self.edge[token] = left, right
        return found

    def stays_apart(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' bytes gives back the two tokens.

        It does not if two parts that touch each other at some time merge before either grows
        otherwise; of equal ranks the leftmost merges first.
        """
        self.pairs += 1
        if self.pairs > PAIRS:
            for known in self.apart.values():
                known.clear()
            self.pairs = 1
        rank = self.ranks.get
        known = True
        for a, a_end in self.edges(left)[1]:
            for b, b_end in self.edges(right)[0]:
                merged = rank(a + b)
                if merged is not None and merged < a_end and merged <= b_end:
                    known = False
        self.apart.setdefault(right, {})[left] = known
        return known

    def step(self, key: int) -> int:
        """The state after a byte that was not met in this state before."""
        started, byte = self.states[key >> 8], key & 255
        grown = [self.children.get(node << 8 | byte) for node in started]
        subset = (*(node for node in grown if node is not None), self.ROOT)
        number = self.number.get(subset)
        if number is None:
            number = self.number[subset] = len(self.states)
            self.states.append(subset)
            # A token that its own merges do not produce can never be the result of an encoding.
            ending = [self.whole[node] for node in subset if node in self.whole]
            self.ending.append([
                (t, n, self.apart.setdefault(t, {})) for t, n in ending if n == 1 or self.merge(self.tokens[t]) == [self.tokens[t]]
            ])
        self.moves[key] = number
        return number

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > 8 * self.lookahead:
            return self.encode_long(piece)
        moves, ending = self.moves, self.ending
        tokens: list[int] = []  # the last token of each prefix
        state = read = 0
        for byte in piece:
            key = state << 8 | byte
            state = moves.get(key)
            if state is None:
                state = self.step(key)
            for token, size, apart in ending[state]:
                if size > read:  # starts the piece
                    break
                fits = apart.get(left := tokens[read - size])
                if fits is None:
                    fits = self.stays_apart(left, token)
                if fits:
                    break
            tokens.append(token)
            read += 1
        return self.history(tokens, read)

    def encode_long(self, piece: bytes) -> list[int]:
        """Like :meth:`encode`, but emits what is certain while the piece is being read."""
        moves, ending = self.moves, self.ending
        out: list[int] = []
        tokens: list[int] = []  # the last token of each prefix since the last emission
        state, before = 0, -1
        for byte in piece:
            key = state << 8 | byte
            state = moves.get(key)
            if state is None:
                state = self.step(key)
            for token, size, apart in ending[state]:
                at = len(tokens) - size
                left = tokens[at] if at >= 0 else before if at == -1 else None
                if left is None:  # would start before what is emitted
                    continue
                if left >= 0:
                    fits = apart.get(left)
                    if fits is None:
                        fits = self.stays_apart(left, token)
                    if not fits:
                        continue
                tokens.append(token)
                break
            if len(tokens) >= 8 * self.lookahead:
                before = self.emit(tokens, out, before)
        return out + self.history(tokens, len(tokens))

    def history(self, tokens: list[int], end: int) -> list[int]:
        found, sizes = [], self.sizes
        while end > 0:
            token = tokens[end - 1]
            found.append(token)
            end -= sizes[token]
        return found[::-1]

    def emit(self, tokens: list[int], out: list[int], before: int) -> int:
        """Move what all histories of the last ``lookahead`` starts share from ``tokens`` to ``out``."""
        ends = set(range(len(tokens) - self.lookahead, len(tokens) + 1))
        while len(ends) > 1:
            end = max(ends)
            ends.remove(end)
            ends.add(end - self.sizes[tokens[end - 1]])
        (end,) = ends
        if end:
            certain = self.history(tokens, end)
            out += certain
            before = certain[-1]
            del tokens[:end]
        return before


class _Memo(dict):
    """Results of ``make`` by text; beyond ``MEMO`` entries those not used since the last turn are forgotten."""

    def __init__(self, make):
        super().__init__()
        self.make = make
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= MEMO:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Whole texts in, ids as little-endian unsigned 32-bit integers out."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.transducer = Transducer(ranks)
        self.split = regex.compile(pattern).findall
        # The same pattern for the faster engine of the standard library, if it can be written for it.
        usual = pattern.replace(r"\p{L}", r"[^\W\d_]").replace(r"[^\s[^\W\d_]\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{N}", r"\d")
        self.split_usual = None if r"\p" in usual else re.compile(usual).findall
        self.pieces = _Memo(self.piece)

    def piece(self, text: str) -> bytes:
        return array("I", self.transducer.encode(text.encode())).tobytes()

    def encode(self, text: str) -> bytes:
        plain = self.split_usual and (text.isascii() and not _CONTROL.search(text) or not _UNUSUAL.search(text))
        return b"".join(map(self.pieces.__getitem__, (self.split_usual if plain else self.split)(text)))


class Utf8Stream:
    """Bytes in any portions in, characters out as soon as they are complete."""

    def __init__(self):
        self.held = b""  # the well-formed start of a character
        self.missing = 0
        self.low, self.high = 0x80, 0xBF  # limits of the next byte

    def feed(self, portion: bytes) -> str:
        out = []
        for byte in portion:
            if self.missing:
                if self.low <= byte <= self.high:
                    self.held += bytes((byte,))
                    self.missing -= 1
                    self.low, self.high = 0x80, 0xBF
                    if not self.missing:
                        out.append(self.held.decode())
                        self.held = b""
                    continue
                out.append("�")
                self.held, self.missing, self.low, self.high = b"", 0, 0x80, 0xBF
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xF4:
                self.held = bytes((byte,))
                self.missing = 1 + (byte >= 0xE0) + (byte >= 0xF0)
                # No overlong forms, no surrogates, nothing above U+10FFFF.
                self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
                self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        rest = "�" if self.held else ""
        self.held, self.missing, self.low, self.high = b"", 0, 0x80, 0xBF
        return rest


def _well_formed(token: bytes) -> str | None:
    try:
        return token.decode()
    except UnicodeDecodeError:
        return None


class Decoder:
    """Ids as the encoder writes them in, text out."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.texts = [None if token is None else _well_formed(token) for token in self.tokens]

    def decode(self, ids: bytes) -> str:
        numbers = array("I", ids)
        parts = list(map(self.texts.__getitem__, numbers))
        if None not in parts:
            return "".join(parts)
        stream, out = Utf8Stream(), []
        for i, part in zip(numbers, parts):
            if part is None or stream.held:
                if self.tokens[i] is None:
                    raise ValueError(f"id {i} is not in the vocabulary")
                part = stream.feed(self.tokens[i])
            out.append(part)
        out.append(stream.end())
        return "".join(out)


@kept
def _encoder(content: bytes, pattern: str) -> Encoder:
    return Encoder(parse_ranks(content), pattern)


@kept
def _decoder(content: bytes) -> Decoder:
    return Decoder(parse_ranks(content))


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", count_col: str = "n_tokens",
    check: bool = False,
) -> DataFrame:
    """``docs`` with ``ids_col`` (ids as little-endian unsigned 32-bit integers) and ``count_col`` (long).

    With ``check`` all ids are decoded again in the same worker, and a text that comes back changed fails.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ranks = spark.sparkContext.broadcast(read_ranks(spark, ranks_path))

    @F.arrow_udf("binary")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        begin("bpe")
        encoder = _encoder(ranks.value, pattern)
        decoder = _decoder(ranks.value) if check else None
        try:
            for batch in batches:
                texts = [x.as_py() or "" for x in batch]
                ids = [encoder.encode(text) for text in texts]
                if decoder and any(decoder.decode(found) != text for found, text in zip(ids, texts)):
                    raise ValueError("a text differs after decoding")
                yield pa.array(ids, pa.binary())
        finally:
            encoder = decoder = None
            end()

    with_ids = docs.withColumn(ids_col, encoded.asNondeterministic()(F.col(text_col)))
    return with_ids.withColumn(count_col, (F.octet_length(ids_col) / 4).cast("long"))


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``text_col``, the text of its ids; null ids are no tokens. An id that is not in the vocabulary fails."""
    spark = encoded.sparkSession
    small_batches(spark)
    ranks = spark.sparkContext.broadcast(read_ranks(spark, ranks_path))

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        begin("bpe")
        decoder = _decoder(ranks.value)
        try:
            for batch in batches:
                yield pa.array([decoder.decode(x.as_py() or b"") for x in batch], pa.string())
        finally:
            decoder = None
            end()

    return encoded.withColumn(text_col, decoded.asNondeterministic()(F.col(ids_col)))
