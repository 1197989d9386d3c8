"""Token-ID output as length-delimited binary records with an offset index.

A shard is a file of frames, in ascending document order:

    length       uint64, little endian, bytes of the payload
    length_crc   uint32, masked CRC-32 of the eight length bytes
    payload      doc_id int64, then the token ids (uint16 if the vocabulary fits, else uint32)
    payload_crc  uint32, masked CRC-32 of the payload

``mask(c) = rotate_right(c, 15) + 0xa282ead8 mod 2**32`` so that a checksum of
data that holds checksums stays meaningful. Beside each shard a file
``.index`` has one pair of uint64 (offset of the frame, number of ids) for
each record, for shuffled reads of single records (:func:`read_record`). The
CRC is the zlib polynomial (there is no Castagnoli CRC among the libraries
at hand). Files are written under a temporary name and renamed, so a task
that is run again leaves one whole file.

Nulls: a null text is an empty text (its record holds the end id alone); a
null doc_id is stored as the smallest int64 and read back as null; it sorts
first. Repeated rows give repeated records. An empty table gives no shards.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mercato.llm.bpe import LATIN_END, WHITE, latin
from mercato.llm.common import PieceCache, scratch_path, stored, strings

MASK_DELTA = 0xA282EAD8  # fixed value of the masked checksums
NULL_ID = -(1 << 63)
DOCS_PER_SHARD = 8_000
WRITE_BYTES = 8 << 20


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    n = struct.pack("<Q", len(payload))
    return b"".join((n, struct.pack("<I", masked(n)), payload, struct.pack("<I", masked(payload))))


def frames(stream) -> Iterator[bytes]:
    """Payloads of a shard, each checked against its two checksums."""
    while head := stream.read(12):
        n, crc = struct.unpack("<QI", head)
        if masked(head[:8]) != crc:
            raise ValueError("a record's length is damaged")
        payload = stream.read(n)
        if masked(payload) != struct.unpack("<I", stream.read(4))[0]:
            raise ValueError("a record's payload is damaged")
        yield payload


class SpacePieces:
    """Ids of texts, piece by piece, each pre-token encoded by the library once.

    A piece is a space with what follows up to the next space. The byte-level
    pre-tokenizer always starts a new pre-token at a space that stands before
    something other than white space, so the pieces' ids put together are the
    text's. New pieces are cut into pre-tokens here (characters up to Latin
    Extended-B; the library cuts the others), and the library encodes the new
    pre-tokens of a block of texts in one call. Texts in which a space stands
    before white space or at the end, or that hold an added token's string, go
    to the library whole.
    """

    def __init__(self, path: str, dtype: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tok, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for t in (self.tok, self.plain):
            t.no_truncation()
            t.no_padding()
        # the same vocabulary and merges for what is cut already
        self.plain.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        self.dtype = np.dtype(dtype)
        vocabulary = self.tok.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():  # a character of a byte-level token is a byte
            self.sizes[i] = len(token)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.odd = re.compile(r" (?:\s|\Z)").search
        letters, numbers = latin("L"), latin("N")
        self.cut = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{letters}]+| ?[{numbers}]+| ?[^{WHITE}{letters}{numbers}]+"
                              f"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+").findall
        self.words = PieceCache(self.encode_words, 200_000)
        self.inner = PieceCache(self.learn, 500_000)  # asked first, so it saves most
        self.first = PieceCache(lambda pieces: [self.whole(p) for p in pieces], 20_000)

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode_words(self, words: list[str]) -> list[bytes]:
        """One call for all. The bytes that tokens stand for tell which word each one is of."""
        ids = self.plain.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids
        ids = np.array(ids, self.dtype)
        ends = np.cumsum(np.fromiter((len(w.encode()) for w in words), np.int64, len(words)))
        upto = np.cumsum(self.sizes[ids])
        cut = np.searchsorted(upto, ends) + 1
        if len(upto) and (upto[cut - 1] != ends).any():
            raise ValueError("a token goes over the end of a word")
        data, w = ids.tobytes(), self.dtype.itemsize
        cut = (cut * w).tolist()
        return [data[a:b] for a, b in zip([0, *cut], cut)]

    def learn(self, pieces: list[str]) -> list[bytes]:
        """``pieces`` without their space, which is where each one starts when all are cut at once."""
        known = [p for p in pieces if p.isascii() or max(p) < chr(LATIN_END)]
        words = self.cut(" " + " ".join(known)) if known else []
        found: list[bytes] = []
        for w, ids in zip(words, self.words.values_of([words])[0]):
            if w[0] == " ":
                found.append(ids)
            else:
                found[-1] += ids
        if len(known) == len(pieces):
            return found
        of = dict(zip(known, found, strict=True))
        return [of[p] if p in of else self.whole(" " + p) for p in pieces]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for lo in range(0, len(texts), 512):
            part = texts[lo : lo + 512]
            odd = [self.odd(t) is not None or any(a in t for a in self.added) for t in part]
            split = [[] if o else t.split(" ") for t, o in zip(part, odd)]
            heads = self.first.values_of([p[:1] for p in split])
            for p in split:
                del p[:1]
            for t, o, h, v in zip(part, odd, heads, self.inner.values_of(split)):
                yield self.whole(t) if o else h[0] + b"".join(v)


_ENCODERS: dict[tuple, SpacePieces] = {}


def encoder(path: str, dtype: str) -> SpacePieces:
    key = (path, dtype)
    if key not in _ENCODERS:
        _ENCODERS[key] = SpacePieces(path, dtype)
    return _ENCODERS[key]


def id_type(tokenizer_path: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 else "<u4"


def as_uri(path: str) -> str:
    """``file:/a`` and ``/a`` as ``file:///a``; other stores as they are."""
    return "file://" + re.sub("^file:/*", "/", path) if re.match("file:|/", path) else path


def write_records(docs: DataFrame, tokenizer_path: str, out: str, end_id: int = 0, id_col="doc_id",
                  text_col="text", docs_per_shard: int = DOCS_PER_SHARD) -> DataFrame:
    """Write every document as one record below ``out`` in ascending id order.

    Documents are dealt by ranges of their id, sorted in their range and
    encoded there, each range one shard. Returns the manifest (shard, path,
    n_records, n_ids, least), one small row per shard, stored beside the
    shards.
    """
    dtype = id_type(tokenizer_path)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shards = max(1, -(-rows.count() // docs_per_shard))
    ranged = rows.repartitionByRange(shards, F.col("doc_id").asc_nulls_first())
    ranged = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def write(batches):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        shard = ctx.partitionId()
        enc, w = encoder(tokenizer_path, dtype), np.dtype(dtype).itemsize
        end = np.array([end_id], dtype).tobytes()
        fs = stream = None
        index, buf, at, n_ids, pending, least = [], [], 0, 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if stream is None:
                fs, base = pafs.FileSystem.from_uri(out)
                fs.create_dir(base, recursive=True)
                name = f"{base}/shard-{shard:06d}.rec"
                temp = f"{base}/.shard-{shard:06d}-{ctx.taskAttemptId()}"
                stream = fs.open_output_stream(f"{temp}.rec")
            ids = batch.column(0).to_pylist()
            for doc, data in zip(ids, enc.encode(strings(batch.column(1)))):
                doc = NULL_ID if doc is None else doc
                least = doc if least is None else least
                f = frame(struct.pack("<q", doc) + data + end)
                buf.append(f)
                n = len(data) // w + 1
                index.append((at, n))
                at, n_ids, pending = at + len(f), n_ids + n, pending + len(f)
                if pending > WRITE_BYTES:
                    stream.write(b"".join(buf))
                    buf, pending = [], 0
        if stream is None:
            return
        stream.write(b"".join(buf))
        stream.close()
        with fs.open_output_stream(f"{temp}.index") as s:
            s.write(np.array(index, "<u8").tobytes())
        for source, target in ((f"{temp}.index", f"{name}.index"), (f"{temp}.rec", name)):
            if fs.get_file_info(target).type != pafs.FileType.NotFound:  # of a task that is run again
                fs.delete_file(target)
            fs.move(source, target)
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "path": [f"{out}/shard-{shard:06d}.rec"],
            "n_records": pa.array([len(index)], pa.int64()), "n_ids": pa.array([n_ids], pa.int64()),
            "least": pa.array([least], pa.int64()), "id_type": [dtype],
        })

    return stored(ranged.mapInArrow(
        write, "shard int, path string, n_records long, n_ids long, least long, id_type string"), "manifest")


def read_records(manifest: DataFrame, fn=None, schema: str = "doc_id long, start long, ids array<long>") -> DataFrame:
    """Read shards back, checked, one task a shard; ``start`` is the number of ids of all records before.

    ``fn(doc_id, start, ids)`` may turn each record into another row of ``schema``.
    """
    # one row per shard: a small window
    before = F.coalesce(F.sum("n_ids").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = manifest.select("shard", "path", "id_type", before.cast("long").alias("start"))
    names = [c.split()[0] for c in schema.split(", ")]

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = pafs.FileSystem.from_uri(row["path"])
                start, out = row["start"], []
                with fs.open_input_stream(path, buffer_size=1 << 20) as s:
                    for payload in frames(s):
                        doc = struct.unpack_from("<q", payload)[0]
                        ids = np.frombuffer(payload, row["id_type"], offset=8)
                        doc = None if doc == NULL_ID else doc
                        out.append(fn(doc, start, ids) if fn else (doc, start, ids.tolist()))
                        start += len(ids)
                        if len(out) >= 2_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
                            out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)

    n = max(1, manifest.count())
    return parts.repartitionByRange(n, "shard").mapInArrow(read, schema)


def read_record(path: str, k: int, dtype: str = "<u2") -> tuple[int, np.ndarray]:
    """Record ``k`` of a shard by its index: two small reads."""
    fs, base = pafs.FileSystem.from_uri(path)
    with fs.open_input_file(f"{base}.index") as s:
        offset, _ = struct.unpack("<QQ", s.read_at(16, 16 * k))
    with fs.open_input_file(base) as s:
        s.seek(offset)
        payload = next(frames(s))
    return struct.unpack_from("<q", payload)[0], np.frombuffer(payload, dtype, offset=8)


def _digest(doc, start, ids):
    return doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())


def record_digests(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of the records as written and read back."""
    out = scratch_path(docs.sparkSession, "records")
    manifest = write_records(docs, tokenizer_path, as_uri(out), end_id)
    return read_records(manifest, _digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
