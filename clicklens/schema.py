"""Column roles of an impression table.

The reference keeps three incompatible layouts of the same log (positions
13 string or int, a random-forest layout that drops the last ten columns), so
roles are always passed as parameters, never inferred from names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class CtrSchema:
    label: str = "y"
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    key: str | None = None
    # threshold per column (strictly greater is kept); int applies to all
    thresholds: dict = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return list(self.numeric) + list(self.categorical)

    def threshold(self, column: str, default: int = 0) -> int:
        return int(self.thresholds.get(column, default))

    def numeric_sentinel(self, column: str) -> int:
        """Stash value of a numeric column: 1,000,000 + its 1-based position."""
        return STASH_NUMERIC_BASE + self.numeric.index(column) + 1


# Fixed values that must equal the reference's for equal results.
# Stash label of a string column: "stash_" followed by the column name.
# Stash value of the i-th numeric column (1-based): 1,000,000 + i.
STASH_PREFIX = "stash_"
STASH_NUMERIC_BASE = 1_000_000
# Derived column suffixes: stashed, indexed, encoded vector.
STASHED_SUFFIX = "_t"
INDEX_SUFFIX = "_Indx"
VECTOR_SUFFIX = "v"


def reference_tsv_schema(n_numeric: int = 12, n_total: int = 39) -> T.StructType:
    """Headerless impression log: y, n1..n12 (n5 bigint), cat13..cat39."""
    fields = [T.StructField("y", T.IntegerType(), True)]
    for i in range(1, n_numeric + 1):
        fields.append(T.StructField(f"n{i}", T.LongType() if i == 5 else T.IntegerType(), True))
    for i in range(n_numeric + 1, n_total + 1):
        fields.append(T.StructField(f"cat{i}", T.StringType(), True))
    return T.StructType(fields)
