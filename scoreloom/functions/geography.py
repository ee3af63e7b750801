"""Place classes and place indices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.numeric import clamp, clamp01, lookup, number, pick, text

# Keyword lists, country centres and country groups.
TIER_1_CITIES = ("new york", "london", "paris", "tokyo", "berlin", "moscow", "beijing", "shanghai", "mumbai",
                 "delhi", "los angeles", "chicago", "toronto", "sydney", "melbourne")
TIER_2_CITIES = ("manchester", "birmingham", "glasgow", "lyon", "marseille", "frankfurt", "hamburg", "munich",
                 "barcelona", "madrid", "milan", "rome", "amsterdam", "rotterdam")
TIER_3_COUNTRIES = ("United States", "United Kingdom", "Germany", "France")
URBAN_WORDS = ("city", "york", "london", "paris", "berlin", "tokyo", "center", "downtown", "metro", "district")
RURAL_WORDS = ("village", "farm", "county", "rural", "countryside", "valley", "hill", "mountain", "lake")
SUBURBAN_WORDS = ("suburb", "gardens", "heights", "park", "grove", "meadow", "ridge", "estates")
COUNTRY_CENTRES = {
    "United States": (39.8283, -98.5795),
    "United Kingdom": (54.5973, -2.7081),
    "Germany": (51.1657, 10.4515),
    "France": (46.6034, 1.8883),
    "Canada": (56.1304, -106.3468),
}
TIER_DENSITY = {"tier_1": 8000.0, "tier_2": 3000.0, "tier_3": 1200.0, "tier_4": 400.0}
CLASS_DENSITY = {"urban": 1.5, "suburban": 0.7, "rural": 0.2}
COUNTRY_DENSITY = {
    2.0: ("Japan", "South Korea", "Singapore"),
    1.5: ("Netherlands", "Belgium"),
    0.3: ("Canada", "Australia", "Russia"),
    0.8: ("United States",),
}
COUNTRY_ECONOMY = {
    85.0: ("United States", "Canada"),
    80.0: ("Germany", "United Kingdom", "France", "Netherlands"),
    78.0: ("Japan", "South Korea", "Australia"),
    70.0: ("Italy", "Spain"),
    60.0: ("Russia", "Brazil"),
    65.0: ("China", "India"),
}


def _by_country(groups: dict[float, tuple[str, ...]]) -> dict[str, float]:
    return {name: value for value, names in groups.items() for name in names}


def _mentions(value: Column, words: tuple[str, ...]) -> Column:
    """One pattern per list: a test per word would push the generated method over the JIT compiler's size limit."""
    return value.rlike("|".join(words))


def geographic_tier() -> Column:
    city = F.lower(text("city"))
    return pick((_mentions(city, TIER_1_CITIES), "tier_1"), (_mentions(city, TIER_2_CITIES), "tier_2"),
                (text("country").isin(*TIER_3_COUNTRIES), "tier_3"), default="tier_4")


def has_coordinates() -> Column:
    return (number("latitude") != 0) & (number("longitude") != 0)


def urban_class() -> Column:
    city = F.lower(text("city"))
    return pick((_mentions(city, URBAN_WORDS), "urban"), (_mentions(city, RURAL_WORDS), "rural"),
                (_mentions(city, SUBURBAN_WORDS), "suburban"), (has_coordinates(), "urban"),
                default="suburban")


def geographic_mobility(ts: str = "ts") -> Column:
    kind, money, travel, hour = (text("event_type"), text("transaction_type"), text("transport_type"),
                                 F.hour(ts))
    base = (F.lit(0.2)
            + pick((kind == "transportation", 0.6))
            + pick((kind != "transportation", 0.0), (travel.isin("flight", "train_long_distance"), 0.3),
                   (travel.isin("bus", "train_local", "metro"), 0.2), (travel.isin("taxi", "rideshare"), 0.1))
            + pick((kind == "financial", pick((money.isin("atm_withdrawal", "card_payment"), 0.3),
                                              (money == "online_purchase", -0.1))),
                   (kind == "social", 0.2), (kind == "civic", 0.15))
            + pick((hour.between(7, 9) | hour.between(17, 19), 0.2)))
    return clamp01(base)


def distance_from_centre() -> Column:
    """Squared-degree index to the country's centre, not a great-circle distance."""
    country, lat, lon = text("country"), number("latitude"), number("longitude")

    def centre(axis: int) -> Column:
        return lookup(country, {name: at[axis] for name, at in COUNTRY_CENTRES.items()})

    d_lat, d_lon = F.pow(lat - centre(0), F.lit(2.0)), F.pow(lon - centre(1), F.lit(2.0))
    known = country.isin(*COUNTRY_CENTRES)
    return pick((~known & has_coordinates(), 50.0), (~known, 100.0), ((lat == 0) & (lon == 0), 150.0),
                default=F.abs(F.lit(111.32) * (d_lat + d_lon * F.lit(0.5))))


def with_place_classes(df: DataFrame) -> DataFrame:
    """Add tier and class first; the indices then reuse the two columns instead of repeating the word searches."""
    return df.withColumns({"geographic_tier": geographic_tier(), "urban_class": urban_class()})


def population_density() -> Column:
    """Needs the columns of :func:`with_place_classes`."""
    tier, kind, country = F.col("geographic_tier"), F.col("urban_class"), text("country")
    return (lookup(tier, TIER_DENSITY, 100.0) * lookup(kind, CLASS_DENSITY, 1.0)
            * lookup(country, _by_country(COUNTRY_DENSITY), 1.0))


def economic_index() -> Column:
    """Needs the columns of :func:`with_place_classes`."""
    tier, kind, country, region = (F.col("geographic_tier"), F.col("urban_class"), text("country"),
                                   F.lower(text("region")))
    return clamp(
        lookup(country, _by_country(COUNTRY_ECONOMY), 55.0)
        + pick((_mentions(region, ("capital", "central")), 10.0))
        + pick((kind == "urban", 5.0), (kind == "rural", -10.0))
        + pick((tier == "tier_1", 8.0), (tier == "tier_2", 3.0), (tier == "tier_4", -5.0)), 0.0, 100.0)
