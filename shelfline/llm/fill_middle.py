"""Fill-in-the-middle transformation as a pipeline of Arrow kernels.

A text of n code points is cut twice: the prefix ends after the smaller of
``h1 % (n + 1)`` and ``h2 % (n + 1)`` units, the middle after the larger,
where h1 to h4 are the first four 8-digit groups of the SHA-256 of
``<seed>:<id>``. h3 decides whether the text stays plain, h4 between the
orders prefix-suffix-middle (``psm``) and suffix-prefix-middle (``spm``).

Each Arrow batch goes through the same steps: the texts become a list array
of units (cut at the lead bytes, sharing the text buffer), which is flattened
with its parent indices; offsets give each unit its ordinal; ordinals against
the two cuts give its role; per role the units are filtered, the lists are
rebuilt from the counts per parent and ``binary_join`` makes the pieces. The
batch is walked in windows of ``WINDOW_BYTES``, so what the steps hold is
bounded whatever the length of a text; a text over several windows has its
pieces joined at the end. No shuffle: one narrow stage, split by the scan.

Markers cannot arise across a seam: each begins with ``<`` and has it nowhere
else, so a text without a marker is rebuilt exactly by the first occurrences.

Defined cases: a null text is empty; an empty text, and a text that holds a
marker, stays plain (counts of pieces null); a null id hashes as the empty
string; rows of one id and text get the same cuts, and each is a row of the
result; very long texts are cut whole; columns named like the added ones are
replaced, others are carried along; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import carried, hex_long

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ADDED = [StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()),
         StructField("middle_chars", LongType()), StructField("output", StringType())]
WINDOW_BYTES = 1 << 20
_HASHES = ["fim_h1_", "fim_h2_", "fim_h3_", "fim_h4_"]
_TEXT = "fim_text_"


def _joined(parents: np.ndarray, values: pa.Array, rows: int) -> pa.Array:
    """The ``values`` of each of ``rows`` parents (ascending) joined."""
    offsets = np.zeros(rows + 1, np.int32)
    np.cumsum(np.bincount(parents, minlength=rows), out=offsets[1:])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), values), "")


def _units(data: pa.Buffer, bounds: np.ndarray, lo: int, hi: int) -> pa.ListArray:
    """The bytes ``lo`` to ``hi`` of a batch as lists of units, a list for
    each text; ``bounds`` are the byte offsets of the texts."""
    window = np.frombuffer(data, np.uint8)[lo:hi]
    starts = np.flatnonzero((window & 0xC0) != 0x80).astype(np.int32)
    offsets = np.append(starts, np.int32(hi - lo))
    flat = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), data.slice(lo, hi - lo))
    lists = np.searchsorted(starts, np.clip(bounds - lo, 0, hi - lo)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(lists), flat)


def cut_pieces(texts: pa.StringArray, first: np.ndarray, second: np.ndarray, window_bytes: int = WINDOW_BYTES) -> list[pa.Array]:
    """Prefix, middle and suffix of each text, cut after ``first`` and
    ``second`` units. ``texts`` holds no null."""
    rows, at = len(texts), texts.offset
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[at:at + rows + 1].astype(np.int64)
    data = texts.buffers()[2]
    roles: list[tuple[list, list]] = [([], []), ([], []), ([], [])]
    done = np.zeros(rows, np.int64)  # units of each text in the windows before
    lo, end = int(bounds[0]), int(bounds[-1])
    view = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    while lo < end:
        hi = min(lo + window_bytes, end)
        while hi < end and view[hi] & 0xC0 == 0x80:  # at most three steps to a lead byte
            hi += 1
        top = int(np.searchsorted(bounds, hi, "left"))
        low = int(np.searchsorted(bounds, lo, "right")) - 1
        units = _units(data, bounds[low:top + 1], lo, hi)
        parent = pc.list_parent_indices(units).to_numpy()
        flat, heads = pc.list_flatten(units), units.offsets.to_numpy()
        ordinal = np.arange(len(flat)) - heads[parent] + done[low:top][parent]
        done[low:top] += np.diff(heads)
        role = (ordinal >= first[low:top][parent]).astype(np.int8) + (ordinal >= second[low:top][parent])
        for k, (parents, pieces) in enumerate(roles):
            mask = role == k
            own = parent[mask]
            present = np.unique(own)
            pieces.append(_joined(np.searchsorted(present, own), pc.filter(flat, pa.array(mask)), len(present)))
            parents.append(present + low)
        lo = hi
    return [_joined(np.concatenate(parents), pa.concat_arrays(pieces), rows) if pieces else pa.array([""] * rows, pa.string())
            for parents, pieces in roles]


def _transform(batch: pa.RecordBatch, keep: list[str], plain_from: int, spm_below: int) -> list[pa.Array]:
    texts = batch.column(_TEXT).cast(pa.string())
    n = pc.cast(pc.utf8_length(texts), pa.int64())
    size = n.to_numpy() + 1
    h1, h2, h3, h4 = (batch.column(c).to_numpy() for c in _HASHES)
    first, second = np.minimum(h1 % size, h2 % size), np.maximum(h1 % size, h2 % size)
    plain = pc.or_(pc.or_(pc.equal(n, 0), pc.match_substring_regex(texts, "<[PSM]>")), pa.array(h3 % 100 >= plain_from))
    spm = pa.array(h4 % 100 < spm_below)
    prefix, middle, suffix = cut_pieces(texts, first, second)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    psm_text = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
    spm_text = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
    none = pa.scalar(None, pa.int64())
    return [*(batch.column(c) for c in keep), n, form, pc.if_else(plain, none, pa.array(first, pa.int64())),
            pc.if_else(plain, none, pa.array(second - first, pa.int64())),
            pc.if_else(plain, texts, pc.if_else(spm, spm_text, psm_text))]


def fill_in_middle(docs: DataFrame, seed: str = "1", id_col: str = "doc_id", text_col: str = "text",
                   plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """``docs`` with n (code points), form, prefix_chars, middle_chars and
    output (the transformed text)."""
    added = [f.name for f in ADDED]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    rest = carried(docs, added)
    keep = docs.select(*rest).schema
    rows = docs.select(*rest, F.coalesce(F.col(text_col), F.lit("")).alias(_TEXT),
                       *[hex_long(digest, 8 * i + 1, 8).alias(c) for i, c in enumerate(_HASHES)])
    names, plain_from = keep.names, 100 - plain_percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = _transform(batch, names, plain_from, spm_percent)
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *added])
    return rows.mapInArrow(run, StructType([*keep.fields, *ADDED]))


def restore(output: Column, form: Column) -> Column:
    """The text that a transformed ``output`` was made from."""
    body = F.split(output, MIDDLE, 2)
    middle = F.element_at(body, 2)
    head = F.substring(F.element_at(body, 1), 4, 2**31 - 1)
    pair = F.split(head, F.when(form == "psm", SUFFIX).otherwise(PREFIX), 2)
    one, two = F.element_at(pair, 1), F.element_at(pair, 2)
    return (F.when(form == "plain", output).when(form == "psm", F.concat(one, middle, two))
            .otherwise(F.concat(two, middle, one)))


def digests(docs: DataFrame) -> DataFrame:
    """The figures of each transformed document, with the hash of its output
    and that of the text rebuilt from it."""
    done = fill_in_middle(docs.select("doc_id", "text"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restore(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
k AS (
  SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
    CASE WHEN n = 0 OR regexp_matches(t, '<[PSM]>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
         WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (
  SELECT *, least(a, b) AS i, greatest(a, b) AS j, substring(t, 1, least(a, b)) AS pre,
    substring(t, least(a, b) + 1, greatest(a, b) - least(a, b)) AS mid, substring(t, greatest(a, b) + 1) AS suf FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN i END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN j - i END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
