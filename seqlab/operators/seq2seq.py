"""Sequence-to-sequence inputs (H1) and masks (H2) in sparse long form.

Input: ``(seq_id, step, channel, value)`` with channels 0..c-1 and the last
valid step per sequence (from a mask, or the last step). Output rows are
``(seq_id, tensor, pos, channel, value)``; cells that are absent are 0:

* tensor 'decoder' (c+1 channels, T+1 steps): data shifted by one step
  (pos = step + 1) plus the GO channel c, set at pos 0 (``go="first"``) or at
  every pos (``go="all"``, what the reference code does);
* tensor 'label' (c+1 channels, T+1 steps): data at pos = step plus the STOP
  channel c at the last valid step (``stop="reference"``) or one after it
  (``stop="after"``).

Everything is a narrow projection plus a union; the last valid step comes
from a partial+final aggregate per sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.operators.projection import last_valid_step


def seq2seq(df: DataFrame, id_col: str = "seq_id", step: str = "step", channel: str = "channel",
            value: str = "value", n_channels: int | None = None, mask: str | None = None,
            go: str = "first", stop: str = "reference", max_step: int | None = None) -> DataFrame:
    if go not in ("first", "all") or stop not in ("reference", "after"):
        raise ValueError("go must be 'first'|'all', stop 'reference'|'after'")
    base = df.select(F.col(id_col).alias("seq_id"), F.col(step).cast("long").alias("step"),
                     F.col(channel).cast("int").alias("channel"),
                     F.col(value).cast("double").alias("value"),
                     *([F.col(mask).alias("mask")] if mask else []))
    c = F.lit(int(n_channels)) if n_channels is not None else None
    if c is None:
        raise ValueError("n_channels is required")
    # every input cell appears twice: in the decoder input one step later, and
    # in the label at its own step (one pass, one explode)
    data = base.select("seq_id", F.explode(F.array(
        F.struct(F.lit("decoder").alias("tensor"), (F.col("step") + 1).alias("pos"),
                 F.col("channel"), F.col("value")),
        F.struct(F.lit("label").alias("tensor"), F.col("step").alias("pos"),
                 F.col("channel"), F.col("value")))).alias("r")).select("seq_id", "r.*")
    # GO and STOP tokens, one explode over the per-sequence last valid step
    last = last_valid_step(base, "seq_id", "step", "mask" if mask else None, name="last")
    token = lambda tensor, pos: F.struct(F.lit(tensor).alias("tensor"), pos.cast("long").alias("pos"),
                                          c.alias("channel"), F.lit(1.0).alias("value"))
    stop_pos = F.col("last") if stop == "reference" else F.col("last") + 1
    if go == "first":
        toks = F.array(token("decoder", F.lit(0)), token("label", stop_pos))
    else:
        # every position 0..T of the padded tensor; T = the longest sequence of all
        longest = F.lit(int(max_step)) if max_step is not None else last.select(F.max("last")).scalar()
        last = last.withColumn("longest", longest)
        tlen = F.col("longest") + 1
        gos = F.transform(F.sequence(F.lit(0).cast("long"), tlen.cast("long")), lambda p: token("decoder", p))
        toks = F.concat(gos, F.array(token("label", stop_pos)))
    tokens = last.select("seq_id", F.explode(toks).alias("r")).select("seq_id", "r.*")
    return data.unionByName(tokens)


def extend_mask(df: DataFrame, id_col: str = "seq_id", pos: str = "pos", mask: str = "mask",
                batch_id: str | None = None) -> DataFrame:
    """H2: new mask = a leading 1 followed by the old mask (positions shift by
    one); the leading row comes from the row at position 0, in the same pass.

    With ``batch_id``, batches whose sequences all have one length have no mask
    (the reference passes none): their rows are left out.
    """
    if batch_id is not None:
        padded = df.groupBy(F.col(batch_id).alias("__b")).agg(F.min(mask).alias("__m")).where("__m = 0")
        df = df.join(padded, F.col(batch_id).eqNullSafe(F.col("__b")), "left_semi")
    row = lambda p, m: F.struct(p.cast("long").alias("pos"), m.cast("int").alias("mask"))
    own = row(F.col(pos) + 1, F.col(mask))
    rows = F.when(F.col(pos) == 0, F.array(row(F.lit(0), F.lit(1)), own)).otherwise(F.array(own))
    return df.select(F.col(id_col).alias("seq_id"), F.explode(rows).alias("r")).select("seq_id", "r.*")
