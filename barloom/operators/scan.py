"""Linear recurrences y[t] = q*y[t-1] + (1-q)*x[t] as window aggregates, and those whose q varies.

y[t] is a sum of q**(t-i) times the inputs. A plain prefix sum of x[i]/q**i overflows on long
series, so the rows of a symbol are cut into blocks: inside a block the prefix sum is safe,
and the value carried into a block folds the ends of the blocks before it. When the caller
knows that no symbol has more rows than one block, there is nothing to carry and the scan is
a single running sum in date order.

With a factor that varies from row to row, y[t] = a[t]*y[t-1] + b[t], the powers of q become running
products of the factors. A block is then an affine map of the value carried into it: its product
and its own end, composed in block order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.schema import CODE, DATE

RN = "_rn"
BLK = "_blk"
#: In a resumed run: rows before the first given one, the number of the last old row, the values
#: of the recurrences there, and the first close. All are null for a history that starts here.
BEFORE, HELD, CARRY, BASE = "_before", "_held", "_carry", "_base"

# q**-length stays below about 1e120 for the fastest decay.
LOG_LIMIT = 276.0
MAX_BLOCK = 4096


@dataclass
class Recurrence:
    """``gain * x`` drives the recurrence from row ``start`` on.

    With ``seed_rows`` = n the recurrence starts as the plain mean of n rows: the rows
    start .. start+n-1 form the mean, and the drive begins at row start+n.
    """

    decay: float
    value: Column
    gain: float = 1.0
    start: int = 1
    seed_rows: int = 0

    @property
    def seed_row(self) -> int:
        return self.start + self.seed_rows - 1


@dataclass
class Varying(Recurrence):
    """``factor * y + value`` from row ``start`` on; ``decay`` is a lower bound of the factors.

    ``seed`` is the value at the row before ``start``. Factors are above 0.
    """

    factor: Column | None = None
    seed: Column | None = None

    @property
    def seed_row(self) -> int:
        return self.start - 1

    def product(self, frame, resumed: bool = False) -> Column:
        """Running product of the factors."""
        driven = _from(F.col(RN) >= self.start, resumed)
        return F.exp(F.sum(F.when(driven, F.ln(self.factor)).otherwise(0.0)).over(frame))


def _from(start: Column, resumed: bool) -> Column:
    """Rows that drive a recurrence: from its start on, or all new ones where it goes on."""
    return F.when(F.col(HELD).isNull(), start).otherwise(F.col(RN) > F.col(HELD)) if resumed else start


def block_length(recurrences: list[Recurrence]) -> int:
    fastest = min((r.decay for r in recurrences if 0 < r.decay < 1), default=None)
    if fastest is None:
        return MAX_BLOCK
    return max(2, min(MAX_BLOCK, int(LOG_LIMIT / -math.log(fastest))))


def _inside_block(name: str, r: Recurrence, pos: Column, frame, blocked: bool, block: int, resumed: bool) -> Column:
    """The recurrence restarted at the first row of each block."""
    rn = F.col(RN)
    kept = F.col(f"{CARRY}.{name}") if resumed else None
    if isinstance(r, Varying):
        grown = F.col(f"_g_{name}")
        drive = F.when(_from(rn >= r.start, resumed), r.value)
        drive = drive.when(rn == F.col(HELD), kept) if resumed else drive
        at_seed = (rn == r.seed_row) & F.col(HELD).isNull() if resumed else rn == r.seed_row
        return grown * F.sum(drive.when(at_seed, r.seed).otherwise(0.0) / grown).over(frame)
    first_driven = r.start + r.seed_rows
    drive = F.coalesce(r.value, F.lit(0.0)) * r.gain
    if first_driven > 1 or resumed:
        drive = F.when(_from(rn >= first_driven, resumed), drive).otherwise(0.0)
    if r.decay == 0:
        y = drive
    else:
        q = F.lit(float(r.decay))
        y = F.pow(q, pos) * F.sum(drive * F.pow(q, -pos)).over(frame)
    if r.seed_rows:
        # The seed rows lie in the first block, so their running sum shares its window.
        mean = F.sum(F.when(rn.between(r.start, r.seed_row), r.value)).over(frame) / float(r.seed_rows)
        age = (rn - r.seed_row).cast("double")
        reach = rn >= r.seed_row
        if blocked:
            reach = reach & (F.col(BLK) == 0)
        if r.decay == 0:
            reach = rn == r.seed_row
        if resumed:
            reach = reach & F.col(HELD).isNull()
        y = y + F.when(reach, F.pow(F.lit(float(r.decay)), age) * mean).otherwise(0.0)
    if resumed:
        # What was held goes on from the last old row, within its block.
        held = F.col(HELD)
        within = (rn >= held) & (F.col(BLK) == F.floor((held - 1) / block))
        y = y + F.when(within, F.pow(F.lit(float(r.decay)), (rn - held).cast("double")) * kept).otherwise(0.0)
    return y


def _fold_ends(name: str, step: float, product: str | None = None) -> Column:
    """The end of the block before, from the ends of all blocks; one that varies keeps its own step."""
    return F.aggregate(
        "_ends", F.lit(0.0), lambda total, end: total * (end[product] if product else F.lit(step)) + end[name]
    )


def run_recurrences(
    df: DataFrame, cols: dict[str, Column], recurrences: dict[str, Recurrence], block: int, blocked: bool, resumed: bool = False
) -> DataFrame:
    """Add the plain columns and one column per recurrence."""
    varying = {f"_g_{n}": r for n, r in recurrences.items() if isinstance(r, Varying)}
    if not blocked:
        frame = Window.partitionBy(CODE).orderBy(DATE).rowsBetween(Window.unboundedPreceding, 0)
        pos = (F.col(RN) - 1).cast("double")
        if varying:
            df = df.withColumns({g: r.product(frame) for g, r in varying.items()})
        df = df.withColumns(
            {**cols, **{n: _inside_block(n, r, pos, frame, False, block, False) for n, r in recurrences.items()}}
        )
        return df.drop(*varying) if varying else df

    if cols:
        df = df.withColumns(cols)
    pos = F.pmod(F.col(RN) - 1, F.lit(block)).cast("double")
    inside = Window.partitionBy(CODE, BLK).orderBy(DATE).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(CODE).orderBy(BLK, DATE).rowsBetween(Window.unboundedPreceding, -1)
    if varying:
        df = df.withColumns({g: r.product(inside, resumed) for g, r in varying.items()})
    local = {f"_l_{n}": _inside_block(n, r, pos, inside, True, block, resumed) for n, r in recurrences.items()}
    # A series shorter than one block has no ends: its list stays empty.
    ends = F.collect_list(
        F.when(pos == block - 1, F.struct(*[F.col(f"_l_{n}").alias(n) for n in recurrences], *varying))
    ).over(before)
    df = df.withColumns(local).withColumn("_ends", ends)

    out = {}
    for name, r in recurrences.items():
        product = f"_g_{name}" if isinstance(r, Varying) else None
        carried = _fold_ends(name, float(r.decay) ** block, product)
        step = F.col(product) if product else F.pow(F.lit(float(r.decay)), pos + 1)
        out[name] = F.when(F.col(BLK) == 0, F.col(f"_l_{name}")).otherwise(F.col(f"_l_{name}") + step * carried)
    return df.withColumns(out).drop("_ends", *local, *varying)
