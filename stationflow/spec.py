"""Names, thresholds and settings shared by every operator."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Window, WindowSpec
from pyspark.sql import functions as F

# The observation file layout, the names used after clean-up, the label threshold, the
# value of two pi used by the cyclic encodings, and the model's numeric inputs in vector order.
OBSERVATION_DDL = (
    "DATE string, LONGITUDE double, LATITUDE double, TMP double, DEW double, "
    "WND_ANGLE double, WND_RATE double, SLP double, MASK string, TIME_DIFF double"
)
VALID_MASK = "[1 1 1 1 1]"
CANONICAL_NAMES = {
    "DATE": "datetime",
    "TMP": "Temperature",
    "DEW": "DewPoint",
    "WND_ANGLE": "WindDirection",
    "WND_RATE": "WindSpeed",
    "SLP": "Pressure",
}
UNUSED_COLUMNS = ("MASK", "TIME_DIFF", "LONGITUDE", "LATITUDE")
MEASURES = ("Temperature", "DewPoint", "Pressure", "WindSpeed", "WindDirection")
RAIN_THRESHOLD = 2.5
TWO_PI = 2 * 3.14159
NUMERIC_FEATURES = (
    "Temperature",
    "DewPoint",
    "Pressure",
    "WindSpeed",
    "WindDirection",
    "DewPointDepression",
    "Rain",
    "Hour",
    "Month",
    "DayOfWeek",
    "DayOfYear",
    "Hour_sin",
    "Hour_cos",
    "Month_sin",
    "Month_cos",
    "Temp_lag1",
    "Temp_lag3",
    "Temp_lag6",
    "Temp_lag24",
    "DewPoint_lag1",
    "Pressure_lag1",
    "WindSpeed_lag1",
    "Rain_lag1",
    "Rain_lag3",
    "Temp_roll6h",
    "Temp_roll24h",
    "DewPoint_roll6h",
    "Pressure_roll6h",
    "Rain_sum6h",
    "Rain_sum24h",
    "TempChange_1h",
    "DewPointChange_1h",
    "PressureChange_1h",
    "TempDewPoint",
)
MIN_VALID_SHARE = 0.8
STATION_SAMPLE = 200
TEST_SHARE = 0.2
SEED = 42

CLF_LABEL = "label_clf"
REG_LABEL = "label_reg"


@dataclass(frozen=True)
class SeriesSpec:
    """Which columns make a frame a set of series: whose it is, when it was, and what breaks ties."""

    entity: str = "StationID"
    time_text: str = "datetime"
    time: str = "datetime_ts"
    tiebreak: tuple[str, ...] = ("row_key",)
    measures: tuple[str, ...] = MEASURES

    @property
    def order(self) -> tuple[str, ...]:
        return (self.time, *self.tiebreak)

    def window(self) -> WindowSpec:
        return Window.partitionBy(self.entity).orderBy(*self.order)

    @property
    def vector(self) -> str:
        """Name of the one-hot column of the entity."""
        return f"{self.entity}_vec"

    @property
    def feature_columns(self) -> list[str]:
        """The model inputs in vector order: every numeric one, then the one-hot entity."""
        return [*NUMERIC_FEATURES, self.vector]

    def row_id(self):
        """Text key of one row, stable under any partitioning."""
        return F.concat_ws("|", self.entity, *[F.col(c).cast("string") for c in self.tiebreak])


@dataclass(frozen=True)
class ModelSettings:
    """Estimator settings (fixed values: the defaults of the batch variant)."""

    linear_iterations: int = 100
    l2: float = 0.01
    forest_trees: int = 40
    forest_depth: int = 8
    forest_bins: int = 24
    forest_subsample: float = 0.5
    boost_iterations: int = 50
    boost_depth: int = 5
    seed: int = SEED

    @classmethod
    def fast(cls) -> ModelSettings:
        """The lighter variant: fewer trees and boosting rounds."""
        return cls(forest_trees=32, boost_iterations=30)

    def as_text(self) -> str:
        return ",".join(f"{k}={v}" for k, v in sorted(asdict(self).items()))
