"""Settings of the engine.

The values under "fixed values" must equal the reference's for the
results to match; the rest are tuning knobs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values (must match the reference) ---------------------------
# minimum number of reviews a user, then a product, must keep
MIN_REVIEWS_PER_USER = 5
MIN_REVIEWS_PER_PRODUCT = 5
# train / validation / test proportions and seed
SPLIT_WEIGHTS = (0.8, 0.1, 0.1)
SEED = 42
# candidate ALS configurations, in the order they are tried:
# (rank, regParam, maxIter)
ALS_GRID = ((5, 0.05, 10), (10, 0.1, 10), (15, 0.1, 15), (20, 0.2, 15))
# items per recommendation list written by the scorers
TOP_K = 5
# serving: default and bounds of "n"; default overview size; user list cap;
# hint list size; display bar scale factor
SERVE_DEFAULT_N = 5
SERVE_MIN_N = 1
SERVE_MAX_N = 20
OVERVIEW_DEFAULT_LIMIT = 20
OVERVIEW_ITEMS = 5
USER_LIST_CAP = 200
HINT_SIZE = 10
DISPLAY_BAR_SCALE = 1.2
REPORT_SAMPLE_USERS = 5
# label prefix of a product shown by index
PRODUCT_LABEL_PREFIX = "Product_"
# run status words and labels of the run report
STATUS_OK = "SUCCES"
STATUS_WARN = "AVERTISSEMENT"
STATUS_UNKNOWN = "INCONNU"
REPORT_PIPELINE_LABEL = "Kafka -> Spark ALS -> Recommandations"
REPORT_ALGORITHM = "ALS (Alternating Least Squares)"
REPORT_TRAIN_LABEL = "80% du dataset"
REPORT_TEST_LABEL = "10% donnees non vues"
UNKNOWN_USER_ERROR = "Utilisateur {user_id} non trouvé dans les recommandations."
UNKNOWN_USER_HINT = "Essayez un de ces user_idx disponibles : {ids}"
EMPTY_STORE_ERROR = "Aucune recommandation disponible. Lancez d'abord le pipeline Kafka → Spark."
HEALTH_STATUS = "ok"
HEALTH_MESSAGE = "API de recommandation opérationnelle"
METRICS_MISSING_TEXT = "Fichier resultats_rmse.txt non trouvé"
# stream: topic name and trigger interval
STREAM_TOPIC = "reviews_stream"
STREAM_TRIGGER = "10 seconds"
# --- end of fixed values ----------------------------------------------

# Items per stored list: as many as a lookup may ask for (its first 5 are the
# reference's list).
STORE_K = SERVE_MAX_N

# Dictionaries / request sets with at most this many rows are joined with a
# broadcast hint (about 50 MB of hashed relation for string ids); beyond it
# the join is left to the planner (sort-merge + AQE skew splitting).  The
# row count is always known exactly before the join.
BROADCAST_MAX_ROWS = 1_000_000
# Wider rows (factor vectors, whole lists) are also held to this many bytes,
# rows times the width of a row; an id row counts as the second number.
BROADCAST_MAX_BYTES = 64 << 20
ID_ROW_BYTES = 64

# Messages a micro-batch takes at most from a topic (all partitions together):
# a backlog arrives in batches of this size, not at once.
STREAM_OFFSETS_PER_BATCH = 1_000_000

# Rows per factor block in the blocked top-k scorer.  Bounds one cogroup
# task (block_rows x rank floats per side, scored 1024 users at a time);
# larger blocks mean less replication of the other side in the shuffle.
TOPK_BLOCK_ROWS = 16384

# A key with at least this many rows is "hot": its rows are split off and
# joined by broadcast instead of being shuffled into one task.  The hot-key
# set therefore has at most (total rows / HOT_KEY_ROWS) entries.
HOT_KEY_ROWS = 1_000_000

# ALS blocks per side = ratings / this, rounded up.  MLlib seeds the start
# factors per block, so the number must come from the data alone.
RATINGS_PER_ALS_BLOCK = 100_000


@dataclass(frozen=True)
class AlsSettings:
    """MLlib ALS knobs.  The block counts change the start factors (MLlib
    seeds them per block) and so the model."""

    num_user_blocks: int | None = None  # None -> sized from the data
    num_item_blocks: int | None = None
    # iterations whose shuffles are on disk together: each half of one is a
    # factor per rating, a checkpoint a factor per product.  No result depends on it
    checkpoint_interval: int = 1
    concurrency: int | None = None  # grid fits at once; None -> from cores and blocks
    cold_start: str = "drop"
    seed: int = SEED
    extra: dict = field(default_factory=dict)
