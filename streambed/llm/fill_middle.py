"""Fill-in-middle transformation as a pipeline of pyarrow.compute steps over whole batches.

Texts are split into lines as list arrays and flattened with the index of the text each line comes
from; a line's ordinal says whether it belongs to prefix, middle or suffix. Lines are filtered by role,
made lists again, and the lists joined to pieces and the pieces to outputs.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streambed.llm import common

PREFIX, SUFFIX, MIDDLE = MARKERS = ("<P>", "<S>", "<M>")
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
    ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string()),
])


def _remainder(values: pa.Array, divisors: pa.Array) -> pa.Array:
    return pc.subtract(values, pc.multiply(pc.divide(values, divisors), divisors))


def _text(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


def _units(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """All lines with their ends, the index of each one's text, and its ordinal there."""
    lists = pc.split_pattern(texts, pattern="\n")
    lines, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    ordinals = pc.subtract(pa.array(range(len(lines)), pa.int64()), pc.take(lists.offsets.cast(pa.int64()), parents))
    ended = pc.less(ordinals, pc.subtract(pc.take(pc.list_value_length(lists).cast(pa.int64()), parents), 1))
    ends = pc.if_else(ended, _text("\n"), _text(""))
    lines = pc.binary_join_element_wise(lines, ends, _text(""))
    # What follows the last line's end is a line only if it is not empty.
    some = pc.greater(pc.binary_length(lines), 0)
    return lines.filter(some), parents.filter(some), ordinals.filter(some)


def _counts(parents: pa.Array, texts: int) -> pa.Array:
    """How many lines each text has; ``parents`` are in order."""
    found = pc.value_counts(pa.concat_arrays([parents.cast(pa.int64()), pa.array(range(texts), pa.int64())]))
    order = pc.sort_indices(found.field("values"))
    return pc.subtract(found.field("counts").take(order), 1)


def _joined(lines: pa.Array, parents: pa.Array, texts: int) -> pa.Array:
    """The lines of each text as one string."""
    ends = pc.cumulative_sum(_counts(parents, texts))
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), ends])
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, lines), _text(""))


def transform_batch(
    ids: pa.Array, texts: pa.Array, draws: list[pa.Array], plain_percent: int, spm_percent: int
) -> pa.RecordBatch:
    """The outputs of a batch; ``draws`` are four columns of non-negative longs."""
    size = len(texts)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lines, parents, ordinals = _units(texts)
    n = _counts(parents, size)
    places = [_remainder(draw, pc.add(n, 1)) for draw in draws[:2]]
    first, second = pc.min_element_wise(*places), pc.max_element_wise(*places)
    in_prefix = pc.less(ordinals, pc.take(first, parents))
    in_suffix = pc.greater_equal(ordinals, pc.take(second, parents))
    roles = {
        PREFIX: in_prefix,
        MIDDLE: pc.invert(pc.or_(in_prefix, in_suffix)),
        SUFFIX: pc.and_not(in_suffix, in_prefix),
    }
    piece = {marker: _joined(lines.filter(role), parents.filter(role), size) for marker, role in roles.items()}

    hundred = pa.scalar(100, pa.int64())
    plain = pc.or_(pc.equal(n, 0), pc.greater_equal(_remainder(draws[2], hundred), plain_percent))
    for marker in MARKERS:
        plain = pc.or_(plain, pc.match_substring(texts, marker))
    spm = pc.less(_remainder(draws[3], hundred), spm_percent)
    spelled = [
        pc.binary_join_element_wise(*[x for m in order for x in (_text(m), piece[m])], _text(""))
        for order in ((SUFFIX, PREFIX, MIDDLE), (PREFIX, SUFFIX, MIDDLE))
    ]
    chars = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(piece[m]).cast(pa.int64())) for m in (PREFIX, MIDDLE)]
    return pa.RecordBatch.from_arrays(
        [
            ids,
            n,
            pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
            *chars,
            pc.if_else(plain, texts, pc.if_else(spm, *spelled)).cast(pa.string()),
        ],
        schema=_ARROW,
    )


def transform(
    docs: DataFrame,
    seed: int = 7,
    fim_percent: int = 100,
    spm_percent: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n (its lines), form, prefix_chars, middle_chars and output.

    The cuts and the form follow from a hash of seed and id alone: of all documents ``fim_percent`` in a
    hundred are transformed, of these ``spm_percent`` with the suffix first (spm), the others with the
    prefix first (psm). A document without text, or one that holds a marker, stays as it is (plain), and
    its two counts are null. Prefix, middle and suffix consist of whole lines; any may be empty.

    A null text counts as empty. All null ids draw alike and stay null; rows with equal ids draw alike and
    are transformed each for itself. Other columns are left out. No rows give no rows. A text is cut whole.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]

    def run(batches):
        for batch in batches:
            ids, texts, *drawn = batch.columns
            at = 0
            while at < batch.num_rows:
                end = _group(texts, at)
                part = slice(at, end)
                yield transform_batch(ids[part], texts[part], [d[part] for d in drawn], fim_percent, spm_percent)
                at = end

    found = common.small_batches(docs).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return found.select("doc_id", "text", *draws).mapInArrow(run, SCHEMA)


def _group(texts: pa.Array, start: int) -> int:
    """The end of the rows from ``start`` on whose texts together have some OUT_BYTES, one at least."""
    size, end = 0, start
    while end < len(texts) and (end == start or size < common.OUT_BYTES):
        size += len(texts[end].as_buffer() or b"") if texts[end].is_valid else 0
        end += 1
    return end


def restore(output: Column, form: Column) -> Column:
    """The exact text that an output was made from; null if either is null.

    No marker begins inside another and a transformed text holds none, so a marker's first place in an
    output is its own.
    """
    after = lambda marker: F.split_part(output, F.lit(marker), F.lit(2))
    until = lambda piece, marker: F.split_part(piece, F.lit(marker), F.lit(1))
    prefix = until(until(after(PREFIX), SUFFIX), MIDDLE)
    suffix = until(until(after(SUFFIX), PREFIX), MIDDLE)
    return F.when(form == "plain", output).when(form.isin("psm", "spm"), F.concat(prefix, after(MIDDLE), suffix))
