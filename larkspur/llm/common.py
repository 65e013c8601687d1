"""Shared pieces: shared-folder checkpoints, size-checked broadcasts, row keys, Arrow text buffers, word hashes."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a side that may be broadcast; a side is counted before it is broadcast. At 64 bytes a row this is 16 MB.
BROADCAST_ROWS = 250_000
#: Bytes of text that one numpy pass works on.
SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch on its way to a Python worker; by rows alone, 10,000 long texts would be one batch.
BATCH_BYTES = 1 << 22
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir); a temporary one only in local mode, where the session names none."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if not named:
        if not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="larkspur-checkpoint-"))
        named = sc._jsc.sc().getCheckpointDir().get()
    elif not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint a narrow frame in the shared folder, which ends its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(df: DataFrame) -> DataFrame:
    """Write a wide frame as Parquet in the shared folder and read it back; ends its lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Delete the folders of frames that `table` has written, once all that was made of them is written itself."""
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.rsplit("/", 1)[-1].startswith("table-"):
                path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def cleaned(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps: Spark deletes them once the driver has collected what referred to them."""
    spark.sparkContext._jvm.System.gc()


def released() -> None:
    """Give memory that a Python worker has freed back to the system; workers live on, and the next task may be another's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def batched(df: DataFrame) -> DataFrame:
    """`df`, to be read by a Python function in batches of about BATCH_BYTES, or as the session sets them."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_SETTING, None) is None:
        conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return df


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only where a count shows at most `limit` rows; a larger side is joined by a shuffle."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """`df` with its columns named c0, c1, ..., so that none clashes with an operator's own; and the new name of each."""
    names = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), dict(zip(df.columns, names, strict=True))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Names a document: its doc_id, or a hash of the text where that is null."""
    return F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("#"), F.md5(F.coalesce(F.col(text), F.lit("")))))


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    with np.errstate(over="ignore"):
        x = x + _GOLD
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Zero-copy runs of rows of at most `limit` bytes (or one row): first row, end row, bytes, offsets. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, width)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        end = min(end, n)
        yield at, end, data[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


def _byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """A random 64-bit value for each byte, upper case as lower; which bytes are in words (not ASCII space, control or punctuation)."""
    values = mix(np.arange(256, dtype=np.uint64) + np.uint64(7))
    word = np.ones(256, bool)
    word[:128] = [chr(b).isalnum() for b in range(128)]
    for b in range(ord("A"), ord("Z") + 1):
        values[b] = values[b + 32]
    return values, word


BYTE_VALUE, WORD_BYTE = _byte_classes()
_FACTORS = mix(np.arange(64, dtype=np.uint64) + np.uint64(0xB17E)) | np.uint64(1)


def _factors(n: int) -> np.ndarray:
    """A random odd factor for each place in a word, as many as its longest word needs."""
    global _FACTORS
    if n > len(_FACTORS):
        _FACTORS = mix(np.arange(1 << n.bit_length(), dtype=np.uint64) + np.uint64(0xB17E)) | np.uint64(1)
    return _FACTORS


def word_hashes(data: np.ndarray, offsets: np.ndarray, piece: int = 1 << 20, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of several texts, and the row each word stands in.

    A word is a run of `inside` bytes: ASCII letters, digits and bytes above 127, if not given. ASCII upper case counts as
    lower. Each place in a word has its own random factor, however long the word, and the length counts too. Works on
    pieces of `piece` bytes cut between words, so a long text needs little more memory than its words.
    """
    inside = WORD_BYTE if inside is None else inside
    hashes, rows, at, n = [], [], 0, len(data)
    ends = offsets[1:]
    while at < n:
        stop = min(n, at + piece)
        if stop < n and inside[data[stop - 1]] and inside[data[stop]]:
            back = np.flatnonzero(~inside[data[at:stop]])
            if len(back):
                stop = at + int(back[-1]) + 1
            else:  # a word longer than a piece
                more = np.flatnonzero(~inside[data[stop:]])
                stop = stop + int(more[0]) if len(more) else n
        part = data[at:stop]
        isword = inside[part]
        begin = isword.copy()
        begin[1:] &= ~isword[:-1]
        inner = offsets[(offsets > at) & (offsets < stop)] - at  # a text's start also starts a word
        begin[inner] = isword[inner]
        starts = np.flatnonzero(begin)
        if len(starts):
            where = np.cumsum(begin) - 1
            depth = np.arange(len(part)) - starts[np.maximum(where, 0)]
            depth[~isword] = 0
            with np.errstate(over="ignore"):
                value = BYTE_VALUE[part] * _factors(int(depth.max()) + 1)[depth]
                value[~isword] = 0
                length = np.add.reduceat(isword, starts, dtype=np.uint64)
                hashes.append(mix(np.add.reduceat(value, starts) + length * _GOLD))
            rows.append(np.searchsorted(ends, starts + at, "right"))
        at = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(rows)


def shingle_hashes(words: np.ndarray, rows: np.ndarray, n_rows: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of `width` neighbouring words, with their rows; a text of fewer words (but one) has one shingle of all it has."""
    counts = np.bincount(rows, minlength=n_rows)
    first = np.cumsum(counts) - counts
    out = np.zeros(len(words), np.uint64)
    factors = mix(np.arange(width, dtype=np.uint64) + np.uint64(101)) | np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(width):
            if k < len(words):
                out[: len(words) - k] += words[k:] * factors[k]
    keep = np.zeros(len(words), bool)
    if len(words) >= width:
        keep[: len(words) - width + 1] = rows[: len(words) - width + 1] == rows[width - 1 :]
    for r in np.flatnonzero((counts > 0) & (counts < width)):
        at, c = first[r], counts[r]
        with np.errstate(over="ignore"):
            out[at] = (words[at : at + c] * factors[:c]).sum() + np.uint64(c)
        keep[at] = True
    return mix(out[keep]), rows[keep]
