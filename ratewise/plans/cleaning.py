"""Batch cleaning job: reviews -> cleaned ratings + dictionaries (+ funnel)."""

from __future__ import annotations

import os
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from ratewise import config
from ratewise.operators import clean, encode
from ratewise.session import drop_unused, materialise, remove_materialised


@dataclass
class CleaningResult:
    stages: dict[str, DataFrame]
    ratings: DataFrame
    users: encode.Dictionary
    products: encode.Dictionary

    def funnel(self) -> DataFrame:
        return clean.funnel({**self.stages, "final": self.ratings})


def filtered_reviews(reviews: DataFrame, hot_rows: int = config.HOT_KEY_ROWS) -> dict[str, DataFrame]:
    """The cleaning stages, with the raw reviews read once: deduplicated
    reviews (with the row counts of the funnel), those of active users and the
    active ones are written as Parquet in the shared scratch folder, and
    everything later reads these (a lost executor sends nothing back to the raw
    reviews; the product counts and the product filter don't each join the
    active users).  Nothing after the dedup reads ``Time``, so the active
    stages are without it."""
    counted = materialise(clean.dedup_counted(reviews), "dedup")
    drop_unused(reviews.sparkSession)  # each step's shuffles go before the next one's are written
    stages = {"raw": reviews, "counted": counted, "dedup": clean.deduplicated(counted)}
    users = clean.active_users(stages["dedup"].drop("Time"), hot_rows=hot_rows)
    stages["active_users"] = materialise(users, "active-users")
    drop_unused(reviews.sparkSession)
    products = clean.active_products(stages["active_users"], hot_rows=hot_rows)
    stages["active_products"] = materialise(products, "active")
    drop_unused(reviews.sparkSession)
    return stages


def run_cleaning(reviews: DataFrame, hot_rows: int = config.HOT_KEY_ROWS) -> CleaningResult:
    """The whole chain: filters, both dictionaries, ratings with dense ids."""
    stages = filtered_reviews(reviews, hot_rows)
    ratings, users, products = encode.encode_ratings(stages["active_products"], hot_rows)
    return CleaningResult(stages, ratings, users, products)


def with_kept_ratings(result: CleaningResult) -> CleaningResult:
    """The ratings written once in the shared scratch folder, for readers that
    use them more than once: the id joins and their shuffles run once.  The
    written stages go then: only the ratings and both dictionaries remain."""
    ratings = materialise(result.ratings, "ratings")
    for stage in ("counted", "active_users", "active_products"):
        remove_materialised(result.stages[stage])
    drop_unused(ratings.sparkSession)
    return replace(result, stages={}, ratings=ratings)


def write_cleaning(result: CleaningResult, out_dir: str) -> dict[str, str]:
    """K-1 / K-2: overwrite the ratings and both dictionaries as Parquet."""
    paths = {
        "ratings": os.path.join(out_dir, "cleaned_reviews.parquet"),
        "users": os.path.join(out_dir, "user_mapping.parquet"),
        "products": os.path.join(out_dir, "product_mapping.parquet"),
    }
    result.ratings.write.mode("overwrite").parquet(paths["ratings"])
    result.users.table.write.mode("overwrite").parquet(paths["users"])
    result.products.table.write.mode("overwrite").parquet(paths["products"])
    return paths
