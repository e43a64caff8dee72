"""Declared table schemas. Names, order and types of the stored columns."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType

LAPS = StructType(
    [
        StructField("Driver", StringType()),
        StructField("DriverNumber", StringType()),
        StructField("Team", StringType()),
        StructField("LapNumber", IntegerType()),
        StructField("LapTime", FloatType()),
        StructField("Sector1Time", FloatType()),
        StructField("Sector2Time", FloatType()),
        StructField("Sector3Time", FloatType()),
        StructField("SpeedI1", FloatType()),
        StructField("SpeedI2", FloatType()),
        StructField("SpeedFL", FloatType()),
        StructField("SpeedST", FloatType()),
        StructField("Compound", StringType()),
        StructField("TyreLife", FloatType()),
        StructField("FreshTyre", StringType()),
        StructField("PitInTime", FloatType()),
        StructField("PitOutTime", FloatType()),
        StructField("IsPersonalBest", StringType()),
        StructField("session_type", StringType(), False),
        StructField("season", IntegerType(), False),
        StructField("event", StringType(), False),
        StructField("session", StringType(), False),
    ]
)

# As stored: ``session`` is the requested code and a folder, the long name a column of its own.
BRONZE = StructType([*LAPS.fields, StructField("session_name", StringType())])
# Cleaning takes rows and keeps the columns.
SILVER = BRONZE

RESULTS = StructType(
    [
        StructField("Driver", StringType()),
        StructField("TeamName", StringType()),
        StructField("Position", IntegerType()),
        StructField("GridPosition", IntegerType()),
        StructField("Status", StringType()),
        StructField("Points", FloatType()),
        StructField("season", IntegerType()),
        StructField("event", StringType()),
        StructField("round_number", IntegerType()),
    ]
)

GOLD = StructType(
    [
        StructField("driver", StringType(), False),
        StructField("team", StringType(), False),
        StructField("round_number", IntegerType(), False),
        StructField("event", StringType(), False),
        StructField("season", IntegerType(), False),
        StructField("session_type", StringType(), False),
        StructField("lap_number", IntegerType(), False),
        StructField("compound", StringType()),
        StructField("lap_time_delta", FloatType()),
        StructField("consistency_score", FloatType()),
        StructField("best_sector_combo", FloatType()),
        StructField("tyre_deg_rate", FloatType()),
        StructField("pace_vs_teammate", FloatType()),
        StructField("pace_trend", FloatType()),
        StructField("race_position", IntegerType()),
        StructField("recency_weight", FloatType()),
        StructField("session_weight", FloatType()),
        StructField("sample_weight", FloatType()),
    ]
)

# A round's race pace per driver, as sums that can be added up later.
PACE = StructType(
    [
        StructField("season", IntegerType()),
        StructField("round_number", IntegerType()),
        StructField("driver", StringType()),
        StructField("total_delta", DoubleType()),
        StructField("laps", LongType()),
    ]
)

PREDICTIONS = StructType(
    [
        StructField("driver", StringType()),
        StructField("team", StringType()),
        StructField("event", StringType()),
        StructField("round", IntegerType()),
        StructField("season", IntegerType()),
        StructField("model_version", StringType()),
        StructField("predicted_position", IntegerType()),
        StructField("win_probability", FloatType()),
        StructField("uncertainty", FloatType()),
        StructField("generated_at", StringType()),
    ]
)

DURATIONS = ("LapTime", "Sector1Time", "Sector2Time", "Sector3Time", "PitInTime", "PitOutTime")
FLAGS = ("FreshTyre", "IsPersonalBest")
CRITICAL = ("Driver", "Team", "LapTime", "session_type", "season", "event")
FEATURES = (
    "lap_time_delta",
    "consistency_score",
    "best_sector_combo",
    "tyre_deg_rate",
    "pace_vs_teammate",
    "pace_trend",
)
