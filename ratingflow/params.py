"""Job parameters.

Every tunable of the jobs lives here so a caller can change it without
touching the plans.  Defaults follow the reference behaviour unless a
semantic decision says otherwise (see README, "Semantic decisions").
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# --- fixed values (must equal the reference for equal results) -------------
# Genre list of the statistics job, in the reference's order; the reference
# spells one entry "Ccrime" (a typo that never matches), we use "Crime".
DEFAULT_GENRES = (
    "Action", "Adventure", "Animation", "Comedy", "Crime", "Documentary",
    "Drama", "Family", "Fantasy", "Foreign", "History", "Horror", "Music",
    "Mystery", "Romance", "Science", "Tv", "Thriller", "War", "Western",
)
# Marker that introduces a rating message inside a raw log line.
RATING_PREFIX = "MOVIE_RATING_PREFIX:"
# Constant key put on every cleaned log message.
LOG_KEY = "logProcessor"
# Separator of rating messages (UID|MID|SCORE|TIMESTAMP), recent-list items
# (mid|score), tag strings and stream rec strings (mid:score|mid:score).
MESSAGE_SEP = "|"
# ALS grid of the tuning job: ranks x regularisation, 5 iterations each.
GRID_RANKS = (30, 40, 50, 60, 70)
GRID_REGS = (1.0, 0.1, 0.001)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Params:
    """All knobs of the jobs; immutable, use ``with_(...)`` to derive."""

    # top-k sizes
    recent_k: int = 20          # recent ratings per user used for scoring
    cand_k: int = 20            # similar-movie candidates per message
    user_k: int = 20            # ALS recommendations per user
    genre_k: int = 10           # top movies per genre
    # thresholds
    sim_threshold: float = 0.6  # cosine similarity kept in the item table
    score_threshold: float = 0.6  # similarity needed to count in a stream score
    like_above: float = 3.0     # score > like_above is a "like"
    # statistics
    genres: tuple[str, ...] = DEFAULT_GENRES
    time_zone: str = "UTC"
    # ALS
    rank: int = 50
    max_iter: int = 10
    reg: float = 0.01
    seed: int = 42
    grid_ranks: tuple[int, ...] = GRID_RANKS
    grid_regs: tuple[float, ...] = GRID_REGS
    grid_iter: int = 5
    grid_parallelism: int = 1   # grid points fitted at once (each caches its own blocks)
    holdout: float = 0.0        # 0 = in-sample RMSE as in the reference
    exclude_rated: bool = False  # drop already-rated movies from ALS top-k
    als_blocks: int | None = None  # ALS user/item blocks (None: Spark's default)
    # blocked vector products: rows per block (memory of one block pair
    # is about block_rows^2 * 8 bytes)
    block_rows: int = 1 << 16
    # streaming
    trigger_seconds: int = 2
    append_history: bool = False
    spread_hubs: bool = True    # look for movies that very many messages of a batch name
    history_buckets: int | None = None  # buckets of the ratings by user (UserHistory)
    compact_every: int | None = None    # fold recs and own history every N batches

    def __post_init__(self) -> None:
        for name in ("recent_k", "cand_k", "user_k", "genre_k", "rank", "max_iter",
                     "grid_iter", "block_rows", "trigger_seconds", "grid_parallelism"):
            if int(getattr(self, name)) < 1:
                raise ValueError(f"Params.{name} must be >= 1")
        for name in ("sim_threshold", "score_threshold", "like_above", "reg"):
            v = float(getattr(self, name))
            if v != v or v in (float("inf"), float("-inf")):
                raise ValueError(f"Params.{name} must be finite")
        if self.score_threshold < 0:
            raise ValueError("Params.score_threshold must be >= 0: a missing pair counts as 0")
        if not 0.0 <= self.holdout < 1.0:
            raise ValueError("Params.holdout must be in [0, 1)")
        for name in ("als_blocks", "history_buckets", "compact_every"):
            v = getattr(self, name)
            if v is not None and int(v) < 1:
                raise ValueError(f"Params.{name} must be >= 1 or None")

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)
