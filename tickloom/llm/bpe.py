"""Operator 8: byte-level BPE through a global shuffle of distinct words.

1. Every text is cut into pre-tokens. A task keeps the distinct words of each group of documents
   (neighbouring doc_ids, about `group_bytes` of text) as sorted lists, dealt by hash of the word; texts
   themselves move as compressed blocks per group. Positions stay in the texts: their place is the order
   of words.
2. One shuffle brings equal words of all groups together, where each distinct word is encoded once;
   a hot word comes once per group, not per occurrence.
3. Ids go back to the groups, where documents stream past their group's words and are reassembled by
   position (`encode`).
4. `decode` takes any table of ids and looks the bytes of every id up in the token-byte table, whose
   size is that of the vocabulary. `encode_documents` reassembles, decodes and takes the digests of both
   in one Python stage, a block of texts at a time.

The words are runs of non-space with the blank before them, or runs of spaces; the pattern's matches
never cross those borders, so a word's ids are those of its matches one after the other. Null and empty
texts have no ids and decode to nothing. Repeated rows give repeated rows. Where rows of null or near
doc_ids hold more than twice `group_bytes`, they are dealt to several groups by hash of (doc_id, text);
rows equal in both stay in one, where they stream. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import id_text, saved, sliced, spread

ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
ARROW = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
#: Fixed value: the code points with the White_Space property, as the pattern's \s has them.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
BLOCK_BYTES = 1 << 20
#: Rows of two numbers that are broadcast at most.
FEW = 1 << 20
DECODE_IDS = 1 << 16

_coders: dict[str, object] = {}


def _table(ranks: str) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}


def _coder(ranks: str, pattern: str):
    import tiktoken

    key = hashlib.md5((pattern + ranks).encode()).hexdigest()
    if key not in _coders:
        _coders[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=_table(ranks), special_tokens={})
    return _coders[key]


def token_bytes(table: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all tokens one after the other; start and length of each id."""
    lengths = np.zeros(max(table.values()) + 1, np.int64)
    for token, i in table.items():
        lengths[i] = len(token)
    return np.frombuffer(b"".join(sorted(table, key=table.get)), np.uint8), np.cumsum(lengths) - lengths, lengths


def pack_words(words: list[bytes]) -> bytes:
    """A compressed list of words; sorted ones share their beginnings."""
    lengths = np.fromiter(map(len, words), "<u4", len(words))
    return zstandard.ZstdCompressor(level=9).compress(len(words).to_bytes(8, "little") + lengths.tobytes() + b"".join(words))


def unpack_words(data: bytes) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(data[:8], "little")
    ends = (8 + 4 * n + np.cumsum(np.frombuffer(data, "<u4", n, 8), dtype=np.int64)).tolist()
    return [data[i:j] for i, j in zip([8 + 4 * n, *ends[:-1]], ends, strict=True)] if n else []


def distinct_words(grouped: DataFrame, buckets: int, most: int = 300_000) -> DataFrame:
    """(grp, bucket, words): the distinct words of each group, in sorted lists by hash of the word.

    A task sends what it holds when that exceeds `most` words, so a word may come twice from a group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, set[str]] = {}

        def out():
            for g, words in held.items():
                lists: list[list[bytes]] = [[] for _ in range(buckets)]
                for word in map(str.encode, words):
                    lists[zlib.crc32(word) % buckets].append(word)
                rows = [(i, pack_words(sorted(x))) for i, x in enumerate(lists) if x]
                yield pa.RecordBatch.from_arrays([pa.array([g] * len(rows), pa.int64()), pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.binary())], ["grp", "bucket", "words"])

        for batch in batches:
            for g, text in zip(batch.column("grp").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if text:
                    held.setdefault(g, set()).update(WORDS.findall(text))
            if sum(map(len, held.values())) > most:
                yield from out()
                held = {}
        yield from out()

    return grouped.select("grp", "text").mapInArrow(run, "grp long, bucket int, words binary")


def _grouped(docs: DataFrame, group_bytes: int) -> DataFrame:
    """Texts with their group: neighbouring doc_ids, and hashed parts of those that hold too many bytes.

    The width of a group comes from the bytes an id stands for. Overfull groups are rows of counts, which
    meet the texts by a join, broadcast up to FEW rows.
    """
    rows = id_text(docs)
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    all_ = rows.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.sum(size).alias("bytes")).first()
    span = all_.b - all_.a + 1 if all_.a is not None else 1
    width = max(1, span * group_bytes // max(all_.bytes or 1, group_bytes))
    keyed = rows.withColumn("near", F.coalesce(F.expr(f"doc_id div {width}"), F.lit(-(2**62))))
    full = keyed.groupBy("near").agg(F.sum(size).alias("bytes")).where(F.col("bytes") > 2 * group_bytes)
    parts = saved(full.select("near", F.ceil(F.col("bytes") / group_bytes).alias("parts")), "overfull")
    n = parts.count()
    if not n:
        return keyed.select("doc_id", "text", F.col("near").alias("grp"))
    if n <= FEW:
        parts = F.broadcast(parts)
    split = F.xxhash64("near", F.pmod(F.xxhash64("doc_id", "text"), "parts"))
    return keyed.join(parts, "near", "left").select("doc_id", "text", F.when(F.col("parts").isNotNull(), split).otherwise(F.col("near")).alias("grp"))


def planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 as four runs of bytes: upper bytes, mostly zero, compress to nothing."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def encode_words(words: DataFrame, ranks: str, pattern: str, most: int = 300_000) -> DataFrame:
    """(grp, words, ids): lists of a bucket stand together, and a word is encoded the first time it comes.

    ids holds, compressed, the number of ids of each word and then all ids. A worker that has seen
    `most` distinct words of a bucket starts anew, which costs time only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, seen, bucket, squeeze = _coder(ranks, pattern), {}, None, zstandard.ZstdCompressor(level=9)
        for batch in batches:
            out = []
            for b, data in zip(batch.column("bucket").to_pylist(), batch.column("words").to_pylist(), strict=True):
                if b != bucket or len(seen) > most:
                    bucket, seen = b, {}
                ids = []
                for word in unpack_words(data):
                    own = seen.get(word)
                    if own is None:
                        own = seen[word] = coder.encode_ordinary(word.decode())
                    ids.append(own)
                flat = np.fromiter(chain.from_iterable(ids), "<u4")
                out.append(squeeze.compress(planes(np.concatenate([np.fromiter(map(len, ids), "<u4", len(ids)), flat]))))
            yield pa.RecordBatch.from_arrays([batch.column("grp"), batch.column("words"), pa.array(out, pa.binary())], ["grp", "words", "ids"])

    return words.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "grp long, words binary, ids binary")


def _blocks(grouped: DataFrame) -> DataFrame:
    """Texts as compressed blocks of one group each: (grp, doc_ids, ends, data)."""
    out = pa.schema([("grp", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=9)
        for rows, buf, at in sliced(batches, most=BLOCK_BYTES):
            grp = np.array(rows.column("grp"))
            order = np.argsort(grp, kind="stable")
            ids = rows.column("doc_id").to_pylist()
            for own in np.split(order, np.flatnonzero(np.diff(grp[order])) + 1):
                data = b"".join(buf[at[i] : at[i + 1]].tobytes() for i in own)
                ends = np.cumsum(at[own + 1] - at[own])
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(([grp[own[0]]], [[ids[i] for i in own]], [ends.tolist()], [squeeze.compress(data)]), out, strict=True)], schema=out)

    return grouped.mapInArrow(run, "grp long, doc_ids array<long>, ends array<long>, data binary")


def _tokenizer(ranks_path: str | None, pattern: str | None) -> tuple[str, str]:
    if ranks_path is None or pattern is None:
        import public_tokenizers

        ranks_path, pattern = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    with open(ranks_path, encoding="ascii") as f:
        return f.read(), pattern


def encode(docs: DataFrame, *, ranks_path: str | None = None, pattern: str | None = None, group_bytes: int = 3 << 23, buckets: int | None = None) -> DataFrame:
    """(doc_id, ids) of all documents. buckets: parts that distinct words are dealt to; by default one for each group."""
    return _mixed(docs, ranks_path, pattern, group_bytes, buckets).mapInArrow(assemble, "doc_id long, ids array<int>")


def _mixed(docs: DataFrame, ranks_path: str | None, pattern: str | None, group_bytes: int, buckets: int | None) -> DataFrame:
    """Words with their ids, then blocks of texts, group by group."""
    ranks, pattern = _tokenizer(ranks_path, pattern)
    grouped = _grouped(docs, group_bytes)
    if buckets is None:  # words are shuffled like the groups: as many parts as Spark's setting or the bytes ask for
        total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")).cast("long"))).first()[0] or 0
        buckets = max(256, min(1 << 16, total // (8 * group_bytes)))
    words = encode_words(distinct_words(grouped, buckets), ranks, pattern)
    none, numbers = F.lit(None).cast("binary"), F.lit(None).cast("array<long>")
    mixed = words.select("grp", F.lit(0).alias("kind"), "words", "ids", numbers.alias("doc_ids"), numbers.alias("ends"), none.alias("data")).union(
        _blocks(grouped).select("grp", F.lit(1), none, none, "doc_ids", "ends", "data"),
    )
    return mixed.repartition("grp").sortWithinPartitions("grp", "kind")


def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of every document from its group's words, a block of texts at a time."""
    group, index, parts, counts, known, loose = object(), {}, [], [], None, zstandard.ZstdDecompressor()
    for batch in batches:
        for i, (g, kind) in enumerate(zip(batch.column("grp").to_pylist(), batch.column("kind").to_pylist(), strict=True)):
            if g != group:
                group, index, parts, counts, known = g, {}, [], [], None
            if kind == 0:
                words = unpack_words(batch.column("words")[i].as_py())
                data = from_planes(loose.decompress(batch.column("ids")[i].as_py()))
                begin = sum(map(len, counts))
                index.update((w.decode(), begin + k) for k, w in enumerate(words))
                counts.append(data[: len(words)].astype(np.int64))
                parts.append(data[len(words) :])
                continue
            if known is None:
                lengths = np.concatenate([*counts, np.zeros(0, np.int64)])
                known = np.concatenate([*parts, np.zeros(0, "<u4")]), np.cumsum(lengths) - lengths, lengths
            data, begin, own = loose.decompress(batch.column("data")[i].as_py()), 0, []
            for end in batch.column("ends")[i].as_py():
                words = WORDS.findall(data[begin:end].decode())
                at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
                own.append(known[0][spread(known[1][at], known[2][at])])
                begin = end
            ends = np.cumsum([0, *map(len, own)])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(own).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_ids")[i].values, ids], schema=ENCODED)


def decoder(table: dict[bytes, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the bytes of ids, at most DECODE_IDS ids (or one row) at a time."""
    out = pa.schema([*ENCODED, ("bytes", pa.binary())])
    data_, starts_, lengths_ = token_bytes(table)
    known = lengths_ > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            at = np.array(rows.column("ids").offsets, np.int64)
            i, n = 0, rows.num_rows
            while i < n:
                j = max(i + 1, int(np.searchsorted(at, at[i] + DECODE_IDS, "right")) - 1)
                own = rows.slice(i, j - i)
                ids = np.array(own.column("ids").flatten())  # without what may stand behind a null
                sizes = np.array(pc.fill_null(pc.list_value_length(own.column("ids")), 0), np.int64)
                if len(ids) and (ids.min() < 0 or ids.max() >= len(known) or not known[ids].all()):
                    raise ValueError("ids that the vocabulary does not have")
                sums = np.concatenate([[0], np.cumsum(lengths_[ids])])
                ends = sums[np.concatenate([[0], np.cumsum(sizes)])]
                decoded = data_[spread(starts_[ids], lengths_[ids])].tobytes()
                valid = own.column("ids").is_valid().to_pylist()
                cells = [decoded[x:y] if v else None for v, x, y in zip(valid, ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("ids"), pa.array(cells, pa.binary())], schema=out)
                i = j

    return run


def decode(encoded: DataFrame, *, ranks_path: str | None = None) -> DataFrame:
    """(doc_id, ids, bytes) of a table with doc_id and ids; null ids give null, unknown ones an error."""
    ranks, _ = _tokenizer(ranks_path, "")
    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(lambda batches: decoder(_table(ranks))(batches), "doc_id long, ids array<int>, bytes binary")


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of ids (as little-endian 32-bit numbers) and of their bytes."""
    for rows in batches:
        column = rows.column("ids")
        ids, at = np.array(column.flatten()).astype("<u4"), np.array(column.offsets, np.int64)
        at = (at - at[0]).tolist()
        own = [hashlib.sha256(ids[x:y].tobytes()).hexdigest() for x, y in zip(at[:-1], at[1:], strict=True)]
        decoded = [hashlib.sha256(x.as_buffer()).hexdigest() for x in rows.column("bytes")]
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(at), pa.int64()), pa.array(own, pa.string()), pa.array(decoded, pa.string())], schema=ARROW)


def encode_documents(docs: DataFrame, *, ranks_path: str | None = None, pattern: str | None = None, group_bytes: int = 3 << 23, buckets: int | None = None) -> DataFrame:
    """Digests of all documents' ids (as little-endian 32-bit numbers) and of their decoded bytes."""
    ranks, _ = _tokenizer(ranks_path, "")
    mixed = _mixed(docs, ranks_path, pattern, group_bytes, buckets)
    return mixed.mapInArrow(lambda batches: digests(decoder(_table(ranks))(assemble(batches))), SCHEMA)
