"""Fixed names and record layouts shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# The ordered feature names of a scoring request (positional CSV
# payloads are bound to these names in this order), the label column and the
# two label values with their fitted (alphabetical) order.
FEATURE_COLUMNS = [
    "player_rating_home_player_1", "player_rating_home_player_2",
    "player_rating_home_player_3", "player_rating_home_player_4",
    "player_rating_home_player_5", "player_rating_home_player_6",
    "player_rating_home_player_7", "player_rating_home_player_8",
    "player_rating_home_player_9", "player_rating_home_player_10",
    "player_rating_home_player_11", "player_rating_away_player_1",
    "player_rating_away_player_2", "player_rating_away_player_3",
    "player_rating_away_player_4", "player_rating_away_player_5",
    "player_rating_away_player_6", "player_rating_away_player_7",
    "player_rating_away_player_8", "player_rating_away_player_9",
    "player_rating_away_player_10", "player_rating_away_player_11",
    "ewm_home_team_goals", "ewm_away_team_goals", "ewm_home_team_goals_conceded",
    "ewm_away_team_goals_conceded", "points_home", "points_away",
    "home_weighted_wins", "away_weighted_wins", "avg_home_team_rating",
    "avg_away_team_rating", "home_streak_wins", "away_streak_wins",
    "ewm_shoton_home", "ewm_shoton_away", "ewm_possession_home",
    "ewm_possession_away", "avg_home_rating_attack", "avg_away_rating_attack",
    "avg_away_rating_defence", "avg_home_rating_defence", "average_rating_home",
    "average_rating_away", "num_top_players_home", "num_top_players_away",
    "ewm_home_team_goals_conceded_x_ewm_shoton_home", "attacking_strength_home",
    "attacking_strength_away", "attacking_strength_diff",
]
LABEL = "result_match"
POSITIVE = "home_win"
NEGATIVE = "home_not_win"
CLASSES = [NEGATIVE, POSITIVE]

FEATURE_SCHEMA = T.StructType([T.StructField(c, T.DoubleType(), True) for c in FEATURE_COLUMNS])

PREDICTION_SCHEMA = T.StructType([
    T.StructField("ground_truth", T.StringType(), True),
    T.StructField("numerical_ground_truth_label", T.IntegerType(), True),
    T.StructField("predicted_label", T.StringType(), False),
    T.StructField("predicted_numerical_label", T.IntegerType(), False),
    T.StructField("win_probability", T.DoubleType(), False),
])

GROUND_TRUTH_SCHEMA = T.StructType([
    T.StructField("groundTruthData", T.StructType([
        T.StructField("data", T.StringType()),
        T.StructField("encoding", T.StringType())])),
    T.StructField("eventMetadata", T.StructType([T.StructField("eventId", T.StringType())])),
    T.StructField("eventVersion", T.StringType()),
])

ARRIVAL_SCHEMA = T.StructType([
    T.StructField("detail", T.StructType([
        T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("object", T.StructType([T.StructField("key", T.StringType())])),
    ])),
    T.StructField("batch_id", T.StringType()),
])

TENSOR_SCHEMA = T.StructType([
    T.StructField("collection", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("step", T.LongType()),
    T.StructField("value", T.DoubleType()),
])
