"""Settings of a run. Paths may be overridden by the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

#: Thresholds of the acceptance ladder and hand-judged precision of its rungs.
SIMILARITY, MARGIN_MIN_SCORE, MARGIN, PAIR_SCORE, PAIR_TOP_K = 0.90, 0.85, 0.20, 0.50, 5
DESCRIPTION_CHARS, QUERY_TOKENS, DESCRIPTION_TOKENS = 200, 64, 128
METHODS = ("exact", "embedding", "embedding_margin", "embedding_ce")
PRECISION = {"exact": 1.00, "embedding": 0.67, "embedding_margin": 0.40, "embedding_ce": 0.60}


@dataclass
class Ladder:
    similarity: float = SIMILARITY
    margin_min_score: float = MARGIN_MIN_SCORE
    margin: float = MARGIN
    pair_score: float = PAIR_SCORE
    pair_top_k: int = PAIR_TOP_K
    use_pair_scorer: bool = True


@dataclass
class Config:
    data_dir: str = field(default_factory=lambda: os.environ.get("PREP_DATA_DIR", "data"))
    cache_dir: str = field(default_factory=lambda: os.environ.get("PREP_CACHE_DIR", "cache"))
    sample_size: int | None = 20_000
    use_cache: bool = True
    drop_unmatched: str | None = None  # None, "after_exact", before vectors could rescue them, or "after_all"
    run_titles: bool = True
    run_skills: bool = True
    use_clean_title: bool = True
    use_candidates: bool = True
    use_description: bool = False
    min_skills: int = 1
    save_output: bool = True
    titles: Ladder = field(default_factory=Ladder)
    skills: Ladder = field(default_factory=lambda: Ladder(use_pair_scorer=False))

    def data(self, name: str) -> str:
        return os.path.join(self.data_dir, name)

    def tag(self) -> str:
        return "all" if self.sample_size is None else str(self.sample_size)

    def cached(self, name: str) -> str:
        return os.path.join(self.cache_dir, f"{name}_{self.tag()}")
