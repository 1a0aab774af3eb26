"""Review table specifications.

A ``ReviewSpec`` names the columns an analysis needs: the entity being
reviewed, the review text, the 0/1 label, a row key and the numeric rating
columns. Airline and airport review files are two instances; the synthetic
test tables are a third (see ``opinio.plans.views``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class ReviewSpec:
    entity_col: str
    text_col: str
    label_col: str
    key_col: str | None = None
    rating_cols: tuple[str, ...] = field(default_factory=tuple)
    # OLS runs to compare: (feature columns, fit split, score split)
    ols_runs: tuple[tuple[tuple[str, ...], str, str], ...] = field(default_factory=tuple)


# The airline review file layout, by position (20 columns).
AIRLINE_COLUMNS = [
    "airline_name", "link", "title", "author", "author_country", "date",
    "content", "aircraft", "type_traveller", "cabin_flown", "route",
    "overall_rating", "seat_comfort_rating", "cabin_staff_rating",
    "food_beverages_rating", "inflight_entertainment_rating",
    "ground_service_rating", "wifi_connectivity_rating",
    "value_money_rating", "recommended",
]

# The airport review file layout, by position (20 columns).
AIRPORT_COLUMNS = [
    "airport_name", "link", "title", "author", "author_country", "date",
    "content", "experience_airport", "date_visit", "type_traveller",
    "overall_rating", "queuing_rating", "terminal_cleanliness_rating",
    "terminal_seating_rating", "terminal_signs_rating",
    "food_beverages_rating", "airport_shopping_rating",
    "wifi_connectivity_rating", "airport_staff_rating", "recommended",
]


def all_string_schema(names: list[str]) -> T.StructType:
    """Every column a nullable string: the raw review CSV, cast later."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def _rated(names: list[str]) -> tuple[str, ...]:
    return tuple(n + "f" for n in names if n.endswith("_rating"))


# The 13 OLS runs on airline ratings (feature columns, fit split,
# score split), in the order they are run.
AIRLINE_OLS_RUNS = (
    (("overall_ratingf", "seat_comfort_ratingf", "cabin_staff_ratingf",
      "food_beverages_ratingf", "inflight_entertainment_ratingf", "ground_service_ratingf",
      "wifi_connectivity_ratingf", "value_money_ratingf"),
     "train", "validation"),
    (("seat_comfort_ratingf", "cabin_staff_ratingf", "food_beverages_ratingf",
      "inflight_entertainment_ratingf", "value_money_ratingf"),
     "train", "validation"),
    (("seat_comfort_ratingf", "cabin_staff_ratingf", "food_beverages_ratingf",
      "inflight_entertainment_ratingf", "ground_service_ratingf", "wifi_connectivity_ratingf",
      "value_money_ratingf"),
     "train", "validation"),
    (("cabin_staff_ratingf", "food_beverages_ratingf", "inflight_entertainment_ratingf",
      "ground_service_ratingf", "wifi_connectivity_ratingf", "value_money_ratingf"),
     "validation", "train"),
    (("food_beverages_ratingf", "inflight_entertainment_ratingf", "value_money_ratingf"),
     "train", "validation"),
    (("overall_ratingf", "value_money_ratingf"),
     "train", "validation"),
    (("overall_ratingf", "seat_comfort_ratingf", "cabin_staff_ratingf",
      "food_beverages_ratingf", "inflight_entertainment_ratingf", "ground_service_ratingf",
      "wifi_connectivity_ratingf", "value_money_ratingf"),
     "train", "train"),
    (("overall_ratingf", "seat_comfort_ratingf", "cabin_staff_ratingf",
      "food_beverages_ratingf", "inflight_entertainment_ratingf", "ground_service_ratingf",
      "wifi_connectivity_ratingf", "value_money_ratingf"),
     "train", "validation"),
    (("overall_ratingf", "cabin_staff_ratingf", "food_beverages_ratingf",
      "inflight_entertainment_ratingf", "ground_service_ratingf", "wifi_connectivity_ratingf",
      "value_money_ratingf"),
     "train", "validation"),
    (("overall_ratingf", "cabin_staff_ratingf", "food_beverages_ratingf",
      "ground_service_ratingf", "wifi_connectivity_ratingf", "value_money_ratingf"),
     "train", "validation"),
    (("overall_ratingf", "cabin_staff_ratingf", "ground_service_ratingf",
      "wifi_connectivity_ratingf", "value_money_ratingf"),
     "train", "validation"),
    (("overall_ratingf", "cabin_staff_ratingf", "food_beverages_ratingf",
      "wifi_connectivity_ratingf", "value_money_ratingf"),
     "train", "validation"),
    (("overall_ratingf", "cabin_staff_ratingf", "wifi_connectivity_ratingf",
      "value_money_ratingf"),
     "train", "validation"),
)

AIRLINE = ReviewSpec(
    entity_col="airline_name", text_col="content", label_col="recommendedi",
    key_col="link", rating_cols=_rated(AIRLINE_COLUMNS),
    ols_runs=AIRLINE_OLS_RUNS,
)

AIRPORT = ReviewSpec(
    entity_col="airport_name", text_col="content", label_col="recommendedi",
    key_col="link", rating_cols=_rated(AIRPORT_COLUMNS),
)

# The hand-typed reference means used to fill missing airline
# ratings (overall, seat, staff, food, inflight, ground, wifi, value).
AIRLINE_FILL_MEANS = {
    "overall_ratingf": 6.05623311778669,
    "seat_comfort_ratingf": 3.098869298010084,
    "cabin_staff_ratingf": 3.32342062876573,
    "food_beverages_ratingf": 2.8072132927233797,
    "inflight_entertainment_ratingf": 2.392053876393633,
    "ground_service_ratingf": 2.783941605839416,
    "wifi_connectivity_ratingf": 2.2045855379188715,
    "value_money_ratingf": 3.1677117572692794,
}

# The text-model parameter grid (regParam x elasticNetParam).
REG_PARAMS = [0.0, 0.01, 0.02]
ELASTIC_NET_PARAMS = [0.0, 0.2, 0.4]
