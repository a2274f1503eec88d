"""Token ids in binary files: byte-pair encoding, Simple-8b blocks, reader."""

from __future__ import annotations

import functools
import re
import struct
import zlib
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nestfold.llm import simple8b
from nestfold.llm.common import file_uri, id_shards, make_folders, publish, store, table
from nestfold.llm.files import Files, arrow_schema, batch_of, trimmed
from nestfold.llm.registry import register
from nestfold.session import scratch_path

END_ID = 2
#: Text bytes per shard (one file, one writing task) and ids per section.
SHARD_BYTES, SECTION_IDS = 32 << 20, 1 << 19
#: Pieces of text whose ids a worker keeps at most; it starts afresh beyond.
KEPT_PIECES = 400_000
#: Pieces that the library encodes as one text; rows that are encoded at a time.
JOINED, ROWS = 500, 2048
#: White space of any kind.
WHITE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\pZ]"

#: Fixed values of the file format: magic; section head (documents, ids,
#: words, blocks) in little-endian 64-bit integers. A section goes on with
#: doc ids (int64), null flags of them (uint8), lengths (int64), block offsets
#: (int64) and Simple-8b words (uint64).
MAGIC, HEAD = b"TOKS8B1\n", struct.Struct("<4q")

MANIFEST = "shard int, temp string, name string, docs long, ids long, bytes long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


class PieceEncoder:
    """Ids of whole texts under a byte-level BPE with the usual pre-tokenizer,
    which, like the public 50k one, ends a piece before every space that
    something else than white space follows. Arrow cuts a batch of texts there
    and finds its different pieces; the tokenizers library encodes each of
    those, the ids of pieces met twice in a batch are kept, and the texts' ids
    are put together. The result is that of encoding whole texts
    (``tests/llm/test_llm_queries.py`` compares them); a text with white space
    behind a space is encoded whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # a line feed between two pieces that hold no white space is a token of its own
        ids = self._library(["\n"])[0]
        self.line = ids[0] if len(ids) == 1 else None
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.apart = "|".join([WHITE, *special])
        self.clear()

    def clear(self):
        self.known: dict[str, int] = {}
        self.starts, self.flat = array("q", [0]), array("I")

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of ``pieces`` that a space precedes: all ids, and where each
        piece's begin and how many they are."""
        apart = np.asarray(pc.match_substring_regex(pieces, self.apart)) if self.line is not None else np.ones(len(pieces), bool)
        texts, rest = pieces.to_pylist(), [np.flatnonzero(apart)]
        plain, parts, n = np.flatnonzero(~apart), [], np.zeros(len(pieces), np.int64)
        order = []
        for k in range(0, len(plain), JOINED):
            some = plain[k : k + JOINED]
            ids = np.array(self._library(["".join([f" {texts[i]}\n" for i in some.tolist()])])[0], np.uint32)
            ends = np.flatnonzero(ids == self.line)
            if len(ends) == len(some):
                parts.append(ids[ids != self.line])
                n[some] = np.diff(ends, prepend=-1) - 1
                order.append(some)
            else:
                rest.append(some)
        rest = np.concatenate(rest)
        each = self._library([" " + texts[i] for i in rest.tolist()])
        n[rest] = [len(e) for e in each]
        parts += [np.array(e, np.uint32) for e in each]
        order = np.concatenate([*order, rest])
        start = np.empty(len(pieces), np.int64)
        start[order] = np.cumsum(n[order]) - n[order]
        return (np.concatenate(parts) if parts else np.zeros(0, np.uint32)), start, n

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(self.known) > KEPT_PIECES:
            self.clear()
        cut = pc.split_pattern(texts.cast(pa.large_string()), " ")
        ends = np.asarray(cut.offsets)[1:] - cut.offsets[0].as_py()
        at = np.append(0, ends[:-1])  # each text's first piece, which no space precedes
        coded = cut.flatten().dictionary_encode()
        which, values = np.asarray(coded.indices).astype(np.int64), coded.dictionary
        pieces = values.to_pylist()
        head = np.zeros(len(which), bool)
        head[at] = True
        odd = np.asarray(pc.match_substring_regex(values, f"^(?:$|{WHITE})"))
        whole = np.flatnonzero(np.add.reduceat(odd[which] & ~head, at))

        # ids of the pieces behind a space: kept ones, then those new here
        times = np.bincount(which[~head], minlength=len(pieces))
        place = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero((place < 0) & (times > 0) & ~odd)
        ids, first, n = self._learn(values.take(pa.array(new)))
        old_starts, base = np.frombuffer(self.starts, np.int64).copy(), len(self.flat)
        start, length = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        old = place >= 0
        start[old], length[old] = old_starts[place[old]], np.diff(old_starts)[place[old]]
        start[new], length[new] = base + first, n

        firsts = self._library([pieces[i] for i in which[at].tolist()])
        wholes = dict(zip(whole.tolist(), self._library(texts.take(pa.array(whole)).to_pylist())))
        own = [np.array(wholes.get(k, f), np.uint32) for k, f in enumerate(firsts)]
        sizes = np.array([len(o) for o in own], np.int64)
        flat = np.concatenate([np.frombuffer(self.flat, np.uint32), ids, *own])
        begin, count = start[which], length[which]
        begin[at], count[at] = base + len(ids) + np.cumsum(sizes) - sizes, sizes
        for k in wholes:  # the text's first piece stands for all of it
            count[at[k] + 1 : ends[k]] = 0
        stop = np.cumsum(count)
        out = flat[np.repeat(begin - stop + count, count) + np.arange(int(stop[-1]))]
        for j in np.flatnonzero(times[new] > 1).tolist():
            self.known[pieces[new[j]]] = len(self.known)
            self.flat.frombytes(ids[first[j] : first[j] + n[j]].tobytes())
            self.starts.append(len(self.flat))
        return out, np.add.reduceat(count, at)


@functools.lru_cache(2)
def _encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _section(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    words, offsets = simple8b.encode(ids)
    null = np.array([d is None for d in doc_ids], np.uint8)
    known = np.array([0 if d is None else d for d in doc_ids], "<i8")
    body = (known, null, lengths.astype("<i8"), offsets.astype("<i8"), words.astype("<u8"))
    return HEAD.pack(len(doc_ids), len(ids), len(words), len(offsets) - 1) + b"".join(x.tobytes() for x in body)


def write_token_ids(docs: DataFrame, root: str, tokenizer_path: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode ``docs(doc_id, text)`` and write the ids in ascending ``doc_id``
    order below ``root``, a uri that all executors reach; return the manifest.

    Shards are id ranges of about ``shard_bytes`` text bytes. A task sorts its
    shard (on disk if need be) and streams it to one file, section by section;
    memory holds a section, or a document if that is longer. Files get their
    names as ``publish`` says.

    Null text is an empty text and gives the end id alone. A null ``doc_id``
    comes first; rows with the same id are ordered by a hash of their text.
    An empty table gives no files. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    by_hash = F.xxhash64("text").cast("double") / float(1 << 64) + 0.5
    sizes = rows.select("doc_id", "text", (F.octet_length("text") + 16).cast("long").alias("size"))
    shard, n = id_shards(sizes, "doc_id", "size", shard_bytes, by_hash)
    dealt = rows.withColumn("shard", shard).repartitionByRange(n, "shard").sortWithinPartitions("shard", "doc_id", F.xxhash64("text"))

    def save(batches):
        encode, files, done = _encoder(tokenizer_path), Files(root), []
        now, ids, lengths, names = None, [], [], []

        def flush():
            nonlocal ids, lengths, names
            if names:
                data = _section(names, np.concatenate(lengths), np.concatenate(ids))
                now[2].write(data)
                now[3:] = now[3] + len(names), now[4] + sum(map(len, ids)), now[5] + len(data)
            ids, lengths, names = [], [], []

        def close():
            flush()
            if now:
                now[2].close()
                done.append((now[0], now[1], f"part-{now[0]:06d}.tok", *now[3:]))

        for batch in batches:
            shards = np.asarray(batch.column("shard"))
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1), len(shards)]
            for lo, hi in zip(cuts, cuts[1:]):
                if now is None or now[0] != shards[lo]:
                    close()
                    path, out = files.temp(f"{shards[lo]:06d}")
                    out.write(MAGIC)
                    now = [int(shards[lo]), path, out, 0, 0, len(MAGIC)]
                for k in range(lo, hi, ROWS):
                    some = batch.slice(k, min(ROWS, hi - k))
                    flat, n = encode(some.column("text"))
                    ends = np.cumsum(n)
                    ids.append(np.insert(flat, ends, np.uint32(end_id)))
                    lengths.append(n + 1)
                    names += some.column("doc_id").to_pylist()
                    if sum(map(len, ids)) >= SECTION_IDS:
                        flush()
        close()
        yield batch_of(done, MANIFEST)

    make_folders(docs.sparkSession, root)
    return publish(store(dealt.mapInArrow(trimmed(save), MANIFEST), "tokens-manifest"), root)


def _sections(raw):
    if raw.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a token file")
    while head := raw.read(HEAD.size):
        docs, ids, words, blocks = HEAD.unpack(head)
        get = lambda kind, n: np.frombuffer(raw.read(n * np.dtype(kind).itemsize), kind)
        names, null, lengths, offsets = get("<i8", docs), get("u1", docs), get("<i8", docs), get("<i8", blocks + 1)
        yield names, null, lengths, simple8b.decode(get("<u8", words), offsets, ids)


def read_token_ids(spark: SparkSession, root: str, ids: bool = False) -> DataFrame:
    """One row per document of the files below ``root``: ``doc_id``, ``start``
    (ids of all documents before it), ``n_tokens``, ``ids_crc32`` of the ids as
    little-endian unsigned 32-bit integers, and with ``ids=True`` the ids
    themselves, little-endian in ``ids``."""
    files = spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    before = F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    listed = files.select("name", before.alias("base"))  # one row per file
    schema = READ + (", ids binary" if ids else "")

    def load(batches):
        folder = Files(root)
        for batch in batches:
            for name, base in zip(*(c.to_pylist() for c in batch.columns)):
                with folder.open(name) as raw:
                    for names, null, lengths, values in _sections(raw):
                        data = memoryview(values.astype("<u4").tobytes())
                        ends = np.cumsum(lengths)
                        starts = base + ends - lengths
                        each = [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
                        crc = [zlib.crc32(x) for x in each]
                        columns = [pa.array(names, mask=null.astype(bool)), pa.array(starts), pa.array(lengths), pa.array(crc, pa.int64())]
                        if ids:
                            columns.append(pa.array([bytes(x) for x in each], pa.binary()))
                        yield pa.RecordBatch.from_arrays(columns, schema=arrow_schema(schema))
                        base += int(lengths.sum())

    return listed.repartition(max(1, files.count())).mapInArrow(trimmed(load), schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokens_of(spark: SparkSession, docs: DataFrame) -> DataFrame:
    root = file_uri(scratch_path(spark, "tokens"))
    write_token_ids(docs, root, default_tokenizer())
    return read_token_ids(spark, root)


@register("op7_token_ids")
def op7_token_ids(spark, sf_dir):
    return tokens_of(spark, table(spark, sf_dir, "documents"))
