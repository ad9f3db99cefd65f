"""All search parameters in one place; zeros are honoured, not taken for "unset"."""

from __future__ import annotations

from dataclasses import dataclass

INDEX_TYPES = ("flat_ip", "flat_l2", "ivf", "ivfpq", "opq_ivfpq", "hnsw", "hnswsq8", "hnswpq")
METRICS = ("ip", "l2")


@dataclass(frozen=True)
class SearchParams:
    """Defaults are those of a full search; ``smoke`` and ``trial`` are lighter presets."""

    window_size: int = 11
    stride: int = 1
    normalize: bool = True
    max_unpaired: float | None = None
    # search
    k: int = 50
    threshold: float = 0.7
    index_type: str = "flat_ip"
    metric: str = "ip"
    nlist: int = 1024
    nprobe: int | None = None
    pq_m: int = 32
    pq_bits: int = 8
    opq_m: int = 64
    hnsw_m: int = 32
    ef_construction: int = 200
    ef_search: int | None = None
    exact_rescore: bool | None = None
    #: Share of the exact neighbours that an approximate search aims at: what nprobe leaves open is then learned from a sample, and candidates are ranked by exact scores.
    recall: float | None = None
    # clustering
    cluster_span: int = 80
    min_seeds: int = 2
    diagonal_tolerance: int = 12
    max_diagonal_span: int = 96
    # alignment
    gamma: float = 1.5
    band_width: int = 96
    band_buffer: int = 32
    band_cap: int = 0
    xdrop: float = 50.0
    gap_open: float = 12.0
    gap_extend: float = 2.0
    padding: int = 32
    background_samples: int = 10_000
    seed: int = 42
    score_min: float = -4.0
    score_max: float = 8.0
    top_n: int = 50
    # statistics
    evalue: bool = True
    evd_samples: int = 1000
    sampled_sequences: int = 50_000
    evd_lambda: float | None = None
    evd_k: float | None = None
    #: "compat" takes K = exp(-lambda mu); "gumbel" takes exp(lambda mu) over the mean search space of the null pairs.
    evd_mode: str = "compat"
    #: "pair": both lengths of a pair; "database": the query's length times the nodes of the whole database.
    search_space: str = "pair"
    #: Coordinates from the padded region's origin instead of the path's own cells.
    compat_coords: bool = False

    def __post_init__(self) -> None:
        if self.window_size < 1 or self.stride < 1:
            raise ValueError("window_size and stride must be at least 1")
        if self.max_unpaired is not None and not 0 <= self.max_unpaired <= 1:
            raise ValueError("max_unpaired must lie in [0, 1]")
        if self.index_type not in INDEX_TYPES or self.metric not in METRICS:
            raise ValueError(f"unknown index type or metric: {self.index_type}, {self.metric}")
        if self.evd_mode not in ("compat", "gumbel") or self.search_space not in ("pair", "database"):
            raise ValueError("evd_mode is compat or gumbel, search_space is pair or database")
        if self.recall is not None and not 0 < self.recall <= 1:
            raise ValueError("recall must lie in (0, 1]")
        if self.k < 1 or self.min_seeds < 1:
            raise ValueError("k and min_seeds must be at least 1")

    @property
    def by_l2(self) -> bool:
        """One choice decides both the neighbours' order and how similarities are derived."""
        return self.metric == "l2" or self.index_type == "flat_l2"

    @property
    def rescored(self) -> bool:
        """Approximate distances are replaced by exact ones unless told otherwise."""
        return self.index_type not in ("flat_ip", "flat_l2", "ivf") if self.exact_rescore is None else self.exact_rescore


def smoke(**changes: object) -> SearchParams:
    return SearchParams(**{"k": 20, "threshold": 0.6, "top_n": 5, "background_samples": 2000} | changes)


def trial(**changes: object) -> SearchParams:
    return SearchParams(**{"threshold": 0.65, "top_n": 10, "background_samples": 5000} | changes)
