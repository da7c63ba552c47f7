"""BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never be bridged by a
merge, so a cut there is certain. White space occurs inside no token: texts are
cut there first, and each distinct chunk (after the tokenizer's own normalisation
and pre-tokenisation) again at every other byte pair that no token contains. The
fragments are encoded independently and their ids concatenated; a memo of bounded
size keeps the ids of chunks that come again. The chunks of a slice of texts are
counted off in Arrow: each distinct one is looked up once. Ids and decoded texts equal those of the tokenizers library.

Rows: one out for each in, whatever repeats. A null or empty text has no ids
and decodes to the empty text; null ids decode to the empty text. Texts of any
length are read whole. Other columns pass through; columns named like the
output are replaced.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import Recent, give_back, lists, slices, table, texts, tidy, with_columns

DEFAULT = "word_bpe_49k.json"

#: The pre-tokenizer pattern of the vocabulary file, for ASCII bytes and for text.
ASCII_PIECES = rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+"
TEXT_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"


def vocabulary(name: str = DEFAULT) -> str:
    """The place of a public vocabulary file on this machine; a name with a slash is a path already."""
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the others take the code points from 256 on, in order."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


#: ASCII letters and digits; ASCII white space.
ALNUM = np.array([b < 128 and chr(b).isalnum() for b in range(256)])
SPACES = b" \t\n\r\v\f"
#: 0 for white space, 2 for letters and digits, 3 for full stops and commas, 1 for other bytes.
KINDS = bytes(0 if b in SPACES else 2 if ALNUM[b] else 3 if b in b".," else 1 for b in range(256))
#: Code points for fragments: a byte within a word, and a word's last byte.
INNER, LAST = 0x400, 0x500


class Encoder:
    """Encodes fragments with the merges of a vocabulary file.

    The file's merges are kept in a model over 512 symbols, a byte within a
    word or a word's last byte, so that a fragment from the middle of a word
    is encoded just as it is within the word.
    """

    def __init__(self, path: str, most: int = 600_000):
        from tokenizers import Tokenizer, models, pre_tokenizers

        spec = json.load(open(path))
        model = spec["model"]
        if model["type"] != "BPE" or spec["decoder"] is not None or not model["end_of_word_suffix"]:
            raise ValueError(f"{path}: not a BPE vocabulary with word ends and without a decoder")
        self.path = path
        # what normalises and cuts, without the vocabulary; ``library`` is read only where special tokens occur
        self.cutter = Tokenizer.from_str(json.dumps(spec | {"model": model | {"vocab": {}, "merges": [], "unk_token": None}, "added_tokens": [], "post_processor": None}))
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = [s.encode() for s in special]
        self.number = {c: b for b, c in enumerate(byte_alphabet())}

        def symbols(token: str) -> str:
            raw = [self.number[c] for c in token.removesuffix(suffix)]
            return "".join(chr(INNER + b) for b in raw[:-1]) + chr((LAST if token.endswith(suffix) else INNER) + raw[-1])

        #: inside[x, y]: some token holds the bytes x and y side by side. Every other pair is a certain cut.
        self.inside = np.zeros((256, 256), bool)
        for token in vocab:
            raw = [self.number[c] for c in token.removesuffix(suffix)]
            self.inside[raw[:-1], raw[1:]] = True
        #: Bytes of each token; every single byte is one, so the tokens of a fragment hold all its bytes.
        pieces = {symbols(t): i for t, i in vocab.items()}
        if not all(chr(kind + b) in pieces for kind in (INNER, LAST) for b in range(256)):
            raise ValueError(f"{path}: a vocabulary without a token for each byte")
        self.width = np.zeros(max(pieces.values()) + 1, np.int64)
        self.width[list(pieces.values())] = list(map(len, pieces))
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.model = Tokenizer(models.BPE(pieces, [(symbols(x), symbols(y)) for x, y in merges], cache_capacity=0))
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ascii_pieces, self.text_pieces = re.compile(b"\n|" + ASCII_PIECES), regex.compile("\n|" + TEXT_PIECES)
        self.stops_apart = not self.inside[np.flatnonzero(ALNUM)][:, list(b".,")].any()
        self.high = re.compile(b"[\xc6-\xff]")
        step = max(1, min(50_000, most // 8))
        self.chunks, self.words = Recent(self._chunks, most, step), Recent(self._words, most // 2, step)

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.path)

    def _pieces(self, plain: list[bytes], wide: list[bytes], odd: list[bytes]) -> list[bytes]:
        """Normalise chunks and cut them into words as the file says, with a line feed after each chunk."""
        out = self.ascii_pieces.findall(b"".join(c + b"\n" for c in plain).lower())
        out += [p.encode() for p in self.text_pieces.findall(b"".join(c + b"\n" for c in wide).decode().lower())]
        for c in odd:
            text = self.cutter.normalizer.normalize_str(c.decode("utf-8", "replace"))
            out += [bytes(self.number[x] for x in w) for w, _ in self.cutter.pre_tokenizer.pre_tokenize_str(text)]
            out.append(b"\n")
        return out

    def _chunks(self, chunks: list[bytes]):
        """(chunk, ids) of chunks between white space."""
        plain = [c for c in chunks if c.isascii()]
        rest = [c for c in chunks if not c.isascii()]
        special = [c for c in chunks if b"<|" in c and any(s in c for s in self.special)]
        if special:
            plain, rest = ([c for c in x if c not in special] for x in (plain, rest))
        high = self.high.search
        wide, odd = [c for c in rest if not high(c)], [c for c in rest if high(c)]
        pieces = self._pieces(plain, wide, odd)
        data = b"".join(map(self.words.of(set(pieces)), pieces))
        ends = (np.flatnonzero(np.frombuffer(data, "<i4") == -1) * 4).tolist()
        out = list(zip(plain + wide + odd, [data[a:b] for a, b in zip([0, *(e + 4 for e in ends)], ends)]))
        for c in special:
            ids = self.library.encode(c.decode("utf-8", "replace"), add_special_tokens=False).ids
            out.append((c, np.array(ids, "<i4").tobytes()))
        return out

    def _words(self, words: list[bytes]):
        """(word, ids): cut words at the byte pairs that no token contains and encode the fragments; a line feed gives -1."""
        raw = np.frombuffer(b" ".join(words), np.uint8)
        gap = (raw == 0x20) | (raw == 0x0A)
        after = np.append(gap[1:], True)
        code = raw.astype("<u2") + np.where(after, LAST, INNER).astype("<u2")
        code[gap] = 0x20
        cut = np.flatnonzero(~gap[:-1] & ~after[:-1] & ~self.inside[raw[:-1], raw[1:]])
        text = np.insert(code, cut + 1, 0x20).astype("<u2").tobytes().decode("utf-16-le")
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<i4")
        data = ids.tobytes()
        # the tokens hold the words' bytes one after the other, so their widths tell where each word ends
        upto = np.append(0, np.cumsum(~gap))[np.append(np.flatnonzero(raw == 0x20), len(raw))]
        ends = (np.searchsorted(np.cumsum(self.width[ids]), upto, "right") * 4).tolist()
        line = np.array([-1], "<i4").tobytes()
        return [(w, line if w == b"\n" else data[a:b]) for w, a, b in zip(words, [0, *ends], ends)]

    def _plain(self, text: bytes) -> bytes:
        """Make fewer chunks distinct where that can't change the result: lower-case A-Z below U+0180, where nothing
        composes, and without what may be a special token."""
        if b"<|" in text or not text.isascii() and self.high.search(text):
            return text
        return text.lower()

    def chunked(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """The chunks between white space of all texts, and the number of chunks up to each text's end. A single full
        stop or comma between a letter or digit and white space is a chunk too (no word holds both, so the cut is certain)."""
        data = b"".join([x for t in texts for x in (self._plain(t), b"\n")])
        kind = np.frombuffer(data.translate(KINDS), np.uint8)
        inside = kind != 0
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        if self.stops_apart:
            start[1:-1] |= (kind[1:-1] == 3) & (kind[:-2] == 2) & ~inside[2:]
        offsets = np.append(np.flatnonzero(start[inside]), np.count_nonzero(inside))
        ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
        upto = np.searchsorted(np.flatnonzero(start), ends)
        chunks = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data.translate(None, SPACES))])
        return chunks, upto

    def flat(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's ids end."""
        chunks, upto = self.chunked(texts)
        once = chunks.dictionary_encode()
        distinct = once.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(list(map(self.chunks.of(set(distinct)), distinct)), pa.large_binary()).take(once.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1) // 4 if len(ids) else np.zeros(1, np.int64)
        return np.frombuffer(ids.buffers()[2] or b"", "<i4", int(ends[-1])), ends[upto]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        ids, ends = self.flat(texts)
        return [ids[a:b].tobytes() for a, b in zip([0, *ends.tolist()], ends.tolist())]

    def forget(self) -> None:
        """Give up the memos' memory."""
        for m in (self.chunks, self.words):
            m.now, m.old = {}, {}


#: Entries of the memo and bytes of a slice where a worker must stay small.
SMALL_MEMO, SMALL_SLICE = 40_000, 1 << 19


@functools.lru_cache(2)
def encoder(name: str, most: int = 600_000) -> Encoder:
    out = Encoder(vocabulary(name), most)
    give_back()  # the file's lists
    return out


@functools.lru_cache(2)
def tokens(name: str) -> dict[int, str]:
    """The text of each token."""
    spec = json.load(open(vocabulary(name)))
    if spec["decoder"] is not None:
        raise ValueError(f"{name}: a vocabulary with a decoder of its own")
    return {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}


def joined(ids: list[int], name: str = DEFAULT) -> str:
    """The tokens' texts joined by spaces: this vocabulary has no decoder of its own. Unknown ids are left out."""
    return " ".join([t for t in map(tokens(name).get, ids) if t is not None])


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", vocab: str = DEFAULT, decoded: str | None = None,
           keep: bool = True) -> DataFrame:
    """Add ``ids`` (array of int), the token ids of ``text``, and, if named, ``decoded``, the text decoded from them in
    the same pass. ``keep``: the worker keeps a large memo for later tasks; without, it is small and given up after each."""
    added = [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)]
    if decoded:
        added.append(T.StructField(decoded, T.StringType(), False))
    schema = with_columns(docs.schema, added)
    names = schema.names
    kept = names[:-len(added)]

    def run(batches):
        enc = encoder(vocab) if keep else encoder(vocab, SMALL_MEMO)
        for b in slices(batches, text) if keep else slices(batches, text, SMALL_SLICE):
            coded = enc.encode(texts(b.column(text)))
            columns = [*(b.column(c) for c in kept), lists(coded, pa.int32(), 4)]
            if decoded:
                columns.append(pa.array([joined(np.frombuffer(c, "<i4").tolist(), vocab) for c in coded], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)
        if not keep:
            enc.forget()

    return docs.mapInArrow(run if keep else tidy(run), schema)


def decode(encoded: DataFrame, ids: str = "ids", text: str = "decoded", vocab: str = DEFAULT) -> DataFrame:
    """Add ``text``, decoded from ``ids``."""
    schema = with_columns(encoded.schema, [T.StructField(text, T.StringType(), False)])
    kept = [f.name for f in schema if f.name != text]

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                b = batch.slice(a, 256)
                out = pa.array([joined(x or [], vocab) for x in b.column(ids).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), out], [*kept, text])

    return encoded.mapInArrow(run, schema)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: token count and SHA-256 of its ids and of the text decoded from them."""
    both = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), decoded="decoded")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
