"""BPE encoding as a bounded-lookahead streaming transducer, and decoding as an
incremental state machine. Vocabulary and merges come from a tokenizer file.

**Encoding.** A sequence of tokens is the encoding of a word exactly when each
token's own text is encoded as that token and no merge crosses the boundary of
two neighbours. Both are properties of single tokens and pairs, found by
undoing merges and kept. The transducer reads a word from left to right and
takes the longest token whose boundary with the token before it holds; where
none does, it takes the decision before back. Positions found dead are not
tried again, so a word takes linear time.

**Lookahead.** Whether a merge happens can depend on what follows only through
a chain of merges of ever higher priority, each taking a suffix of the right
part of the one before. The longest such chain, in symbols, is computed from
the merge list (:attr:`BpeModel.lookahead`). A token is stable, and is
emitted, once that many symbols after its end have been read; only the tokens
since then are kept. So memory is constant however long a word is.

**Decoding.** :class:`Decoder` takes ids in portions of any size and gives text;
its state is the bytes of an unfinished character (byte-level decoder) or
whether a separator is due (no decoder: tokens joined by a space).

Words repeat, so the ids of short chunks of text between white space, and of
the pieces in them, are kept in tables of bounded size per Python worker
(``CACHE_ENTRIES``); of a full table only what is used again stays.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import ship_package

CACHE_ENTRIES = 100_000
CACHE_CHUNK_CHARS = 48
SLICE_CHARS = 1 << 18
SLICE_ROWS = 256

# Unicode's white space
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@functools.lru_cache(maxsize=1)
def _unicode_classes() -> dict[str, str]:
    """Letters, numbers and code points without a character, as ranges."""
    found: dict[str, list[list[int]]] = {"L": [], "N": [], "Cn": []}
    for code in range(0x110000):
        category = unicodedata.category(chr(code))
        ranges = found.get(category if category == "Cn" else category[0])
        if ranges is not None:
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return {kind: "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in ranges) for kind, ranges in found.items()}


def _compile(pattern: str) -> re.Pattern:
    """A pattern of a tokenizer file, with its Unicode classes spelled out."""
    classes = _unicode_classes()
    pattern = pattern.replace(r"[\p{L}]", r"\p{L}").replace(r"[\p{N}]", r"\p{N}")
    pattern = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{_SPACE}{classes['L']}{classes['N']}]")
    for kind in "LN":
        pattern = pattern.replace(rf"\p{{{kind}}}", f"[{classes[kind]}]")
    return re.compile(pattern.replace(r"\S", rf"[^{_SPACE}]").replace(r"\s", rf"[{_SPACE}]"))


# the pattern of byte-level files that name none
_BYTE_LEVEL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Python's Unicode tables have every character of the blocks before this one
_AFTER_LATIN = "\u0250"
# characters that str.split() takes for white space and Unicode does not
_NOT_SPACE = re.compile(r"[\x1c-\x1f]")


def byte_alphabet() -> list[str]:
    """The printable character of each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others follow U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in own}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(own))
    return [table[b] for b in range(256)]


class BpeModel:
    """Merges and vocabulary; encodes one word (a string of symbols)."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.end = "\x01" if suffix else ""
        marked = {}                     # token as in the file -> token with the end mark

        def key(token: str) -> str:
            if token not in marked:
                has_end = suffix and token.endswith(suffix) and len(token) == 1 + len(suffix)
                marked[token] = token[0] + self.end if has_end else token
            return marked[token]

        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}    # token -> (rank, left, right)
        parts = []
        for r, (a, b) in enumerate(merges):
            marked[a + b] = key(a) + key(b)
            parts.append((key(a), key(b)))
            ia, ib, ic = vocab[a], vocab[b], vocab[a + b]
            self.rank[ia, ib] = r
            self.made.setdefault(ic, (r, ia, ib))
        self.ids = {key(token): i for token, i in vocab.items()}
        # trie of the tokens: character -> [token or -1, next level or None]
        self.trie: dict[str, list] = {}
        for token, i in self.ids.items():
            level: dict = self.trie
            for c in token[:-1]:
                node = level.setdefault(c, [-1, None])
                if node[1] is None:
                    node[1] = {}
                level = node[1]
            level.setdefault(token[-1], [-1, None])[0] = i
        self.lookahead = self._lookahead(parts)
        self._pairs: dict[tuple[int, int], bool] = {}
        self._whole: dict[int, bool] = {}

    def _symbols(self, token: str) -> int:
        return len(token) - (self.end != "" and token.endswith(self.end))

    def _lookahead(self, merges: list[tuple[str, str]]) -> int:
        """Symbols of the longest chain of merges, each of higher priority than
        the one before and with a suffix of its right part as left part."""
        reach: dict[str, int] = {}      # left part -> longest chain of the merges so far
        most = 0
        for left, right in merges:      # from the highest priority on
            if self.end and right.endswith(self.end):
                chain = 0               # nothing follows the end of a word
            else:
                chain = max((reach.get(right[i:], 0) for i in range(len(right))), default=0)
            chain += self._symbols(right)
            reach[left] = max(reach.get(left, 0), chain)
            most = max(most, chain)
        return most

    def _holds(self, a: int, b: int) -> bool:
        """Whether no merge crosses the boundary between two adjacent tokens:
        undo the merges beside it, the latest first; a merge across it must not
        have come before the ones undone. Of equal ranks the left comes first."""
        found = self._pairs.get((a, b))
        if found is not None:
            return found
        first, before = (a, b), len(self.rank) + 1
        while True:
            r = self.rank.get((a, b))
            if r is not None and r < before:
                ok = False
                break
            in_a, in_b = self.made.get(a), self.made.get(b)
            if in_a is None and in_b is None:
                ok = True
                break
            if in_b is None or (in_a is not None and in_a[0] > in_b[0]):
                before, a = in_a[0], in_a[2]
            else:
                before, b = in_b[0] + 1, in_b[1]
        if len(self._pairs) >= CACHE_ENTRIES:
            self._pairs.clear()
        self._pairs[first] = ok
        return ok

    def _stands(self, token: int) -> bool:
        """Whether a token's own text is encoded as that token."""
        found = self._whole.get(token)
        if found is None:
            made = self.made.get(token)
            found = made is None or (self._stands(made[1]) and self._stands(made[2])
                                     and self._meets(made[1], made[2], made[0]))
            self._whole[token] = found
        return found

    def _meets(self, a: int, b: int, rank: int) -> bool:
        """Whether two tokens are still side by side when the merge of the
        given rank joins them."""
        before = rank
        while True:
            in_a, in_b = self.made.get(a), self.made.get(b)
            if in_a is None and in_b is None:
                return True
            if in_b is None or (in_a is not None and in_a[0] > in_b[0]):
                before, a = in_a[0], in_a[2]
            else:
                before, b = in_b[0] + 1, in_b[1]
            r = self.rank.get((a, b))
            if r is not None and r < before:
                return False

    def stream(self, word: str) -> Iterator[list[int]]:
        """Ids of a word in portions, each as soon as it is stable."""
        trie, pairs, ahead = self.trie, self._pairs, self.lookahead
        text = word + self.end
        stop = len(text)
        path: list[int] = []                    # tokens not yet emitted,
        ends: list[int] = []                    # their ends, and the other
        others: list[list] = []                 # tokens that fit there, the longest last
        dead: set[int] = set()
        at, before, choices = 0, -1, None       # next symbol, token before it, tokens to try
        while at < stop:
            if choices is None:
                choices, level, end = [], trie, at
                while level is not None and end < stop:
                    node = level.get(text[end])
                    if node is None:
                        break
                    end += 1
                    token, level = node
                    if token >= 0:
                        choices.append((end, token))
            while choices:
                end, token = choices.pop()
                if dead and end in dead:
                    continue
                holds = pairs.get((before, token))
                if holds is None:
                    holds = self._holds(before, token) if before >= 0 else self._stands(token)
                if holds:
                    path.append(token)
                    ends.append(end)
                    others.append(choices)
                    at, before, choices = end, token, None
                    break
            else:
                if not path:
                    raise ValueError(f"no encoding of {text[max(0, at - 20):at + 20]!r}")
                dead.add(at)
                path.pop()
                ends.pop()
                choices = others.pop()
                at = ends[-1] if ends else 0
                before = path[-1] if path else -1
                continue
            if len(path) > ahead and ends[len(path) // 4] + ahead <= at:
                n = len(path) // 4 + 1          # stable: emit all but the last of them,
                yield path[:n - 1]              # which the next token is checked against
                del path[:n - 1], ends[:n - 1], others[:n - 1]
                dead = {d for d in dead if d > ends[0]}
        yield path

    def encode(self, word: str) -> list[int]:
        return [i for portion in self.stream(word) for i in portion]


class _Chunks(dict):
    """Ids (little-endian bytes) of chunks, made on first use. Two tables of
    CACHE_ENTRIES at most: when one is full it becomes the old one, from which
    entries come back when used."""

    def __init__(self, make):
        super().__init__()
        self.make = make
        self.old: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        found = self.old.get(chunk)
        if found is None:
            found = self.make(chunk)
        if len(chunk) <= CACHE_CHUNK_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.old = dict(self)
                self.clear()
            self[chunk] = found
        return found


class BpeTokenizer:
    """What a tokenizer file describes, of the two kinds of public BPE files:
    words with an end mark (lower case, white space dropped) and byte level."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.model = BpeModel(model["vocab"], merges, self.suffix)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.words = spec["normalizer"] is not None      # else byte level, text as it is
        if self.words:
            split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
            pattern = split["pattern"]["Regex"]
        else:
            pattern = _BYTE_LEVEL_PATTERN
        self._piece = _compile(pattern)
        self._space = re.compile(f"[{_SPACE}]+")
        # the library's Unicode data is newer than Python's: it encodes the
        # chunks with characters that Python doesn't know
        self._newer = re.compile(f"[{_unicode_classes()['Cn']}]")
        self._path = path
        self._alphabet = byte_alphabet()
        self._latin = str.maketrans({b: self._alphabet[b] for b in range(256)})
        self._pieces = _Chunks(self._encode_piece)
        self._chunks = _Chunks(self._encode_chunk)
        names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.tokens = [names.get(i, "") for i in range(max(names) + 1)]
        self.byte_decoder = (spec["decoder"] or {}).get("type") == "ByteLevel"

    def _encode_piece(self, piece: str) -> bytes:
        if not (piece.isascii() and piece.isprintable() and " " not in piece):
            piece = piece.encode("utf-8", "replace").decode("latin-1").translate(self._latin)
        return b"".join([array("I", p).tobytes() for p in self.model.stream(piece)])

    def _normal(self, chunk: str) -> str:
        # lower case by character: a sigma at a word's end is no special case
        return unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()

    @functools.cached_property
    def _library(self):
        import tokenizers
        return tokenizers.Tokenizer.from_file(self._path)

    def _encode_chunk(self, chunk: str) -> bytes:
        if max(chunk) >= _AFTER_LATIN and self._newer.search(chunk):
            return array("I", self._library.encode(chunk, add_special_tokens=False).ids).tobytes()
        chunk = self._normal(chunk)
        if chunk.isalpha():
            return self._pieces[chunk]
        return b"".join(map(self._pieces.__getitem__, self._piece.findall(chunk)))

    def trim(self) -> None:
        """Let go of the older entries: a worker that is done keeps little."""
        self._chunks.old.clear()
        self._pieces.old.clear()

    def _slices(self, text: str) -> Iterator[str]:
        """The text cut at white space into slices of about SLICE_CHARS."""
        at = 0
        while at < len(text):
            cut = at + SLICE_CHARS
            if cut < len(text):
                found = self._space.search(text, cut)
                cut = found.end() if found else len(text)
            yield text[at:cut]
            at = cut

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids of a text as little-endian unsigned 32-bit integers, in portions.
        Special tokens' own strings in a text are those tokens."""
        parts = self._special.split(text) if self._special and "<|" in text else [text]
        for part in parts:
            if part in self.special:
                yield self.special[part].to_bytes(4, "little")
            elif not self.words:
                for piece in self._piece.finditer(part):
                    yield self._pieces[piece.group()]
            else:
                for piece in self._slices(part):
                    chunks = self._space.split(piece) if _NOT_SPACE.search(piece) else piece.split()
                    yield b"".join(map(self._chunks.__getitem__, filter(None, chunks)))


class Decoder:
    """Ids to text in portions; ``feed`` as often as needed, then ``flush``."""

    def __init__(self, tokenizer: BpeTokenizer):
        self._bytes = tokenizer.byte_decoder
        if self._bytes:
            of = {c: b for b, c in enumerate(byte_alphabet())}
            self._table = [bytes(of[c] for c in t) if all(c in of for c in t) else t.encode()
                           for t in tokenizer.tokens]
            self._state = codecs.getincrementaldecoder("utf-8")("replace")
        else:
            self._table = [t.encode() for t in tokenizer.tokens]
            self._due = False

    def feed(self, ids: bytes) -> str:
        tokens = map(self._table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())
        if self._bytes:
            return self._state.decode(b"".join(tokens))
        text = b" ".join(tokens).decode()
        if not ids:
            return text
        text, self._due = (" " + text if self._due else text), True
        return text

    def flush(self) -> str:
        return self._state.decode(b"", True) if self._bytes else ""

    def restart(self) -> None:
        if self._bytes:
            self._state.reset()
        else:
            self._due = False


@functools.lru_cache(maxsize=4)
def load_tokenizer(path: str) -> BpeTokenizer:
    """One per Python worker and file."""
    return BpeTokenizer(path)


def _encode_batches(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(path)
        decoder = Decoder(tokenizer)
        # a few rows at a time: what a task holds follows them, not the batch
        for batch in (b.slice(lo, SLICE_ROWS) for b in batches for lo in range(0, b.num_rows, SLICE_ROWS)):
            at = batch.schema.get_field_index("text")
            counts, id_digests, text_digests, all_ids = [], [], [], []
            for text in batch.column(at):
                ids_sha, text_sha, size, ids = hashlib.sha256(), hashlib.sha256(), 0, []
                decoder.restart()
                for portion in tokenizer.encode(text.as_py() or ""):
                    ids_sha.update(portion)
                    text_sha.update(decoder.feed(portion).encode())
                    size += len(portion)
                    if with_ids:
                        ids.append(portion)
                text_sha.update(decoder.flush().encode())
                counts.append(size // 4)
                id_digests.append(ids_sha.hexdigest())
                text_digests.append(text_sha.hexdigest())
                if with_ids:
                    all_ids.append(np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int32))
            kept = [(f, c) for f, c in zip(batch.schema, batch.columns) if f.name != "text"]
            columns = [c for _, c in kept] + [pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()),
                                              pa.array(text_digests, pa.string())]
            names = [f.name for f, _ in kept] + ["n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("token_ids")
            yield pa.RecordBatch.from_arrays(columns, names)
        tokenizer.trim()
    return run


def encode_documents(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit
    integers), decoded_sha256 (the text decoded from the ids again) and, if
    asked for, token_ids. One row per row of ``docs``, in one pass without a
    shuffle. Null texts are empty: no tokens, and the digests of nothing.
    Other columns are not read."""
    out = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", token_ids array<int>" if with_ids else "")
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(out).fields])
    return docs.select("doc_id", "text").mapInArrow(_encode_batches(path, with_ids), schema)


def decode_documents(rows: DataFrame, path: str) -> DataFrame:
    """doc_id and the text that each row's ``token_ids`` decode to."""
    def run(batches):
        tokenizer = load_tokenizer(path)
        decoder = Decoder(tokenizer)
        for batch in batches:
            texts = []
            for ids in batch.column(1).to_pylist():
                decoder.restart()
                texts.append(decoder.feed(np.asarray(ids or [], dtype="<u4").tobytes()) + decoder.flush())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])
    schema = T.StructType([rows.schema["doc_id"], T.StructField("text", T.StringType())])
    return rows.select("doc_id", F.col("token_ids")).mapInArrow(run, schema)


def default_tokenizer(spark: SparkSession, name: str) -> str:
    """Path of an installed public vocabulary file."""
    import public_tokenizers
    ship_package(spark)
    return public_tokenizers.path(name)
