"""Options of a matching run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

OUTPUT_COLUMNS = (
    "embedding_similarity", "fuzzy_score", "city_boost", "final_score",
    "backend_used", "txn_cities", "company_cities", "detected_company_name",
)


@dataclass(frozen=True)
class MatchOptions:
    """A missing output flag means the column is shown.

    ``search`` picks the similarity join: ``sparse`` (n-gram TF-IDF, exact),
    ``exact``, ``lsh`` or ``probed`` over supplied vectors, or ``auto``: sparse without
    supplied vectors, and with them exact, at any size. ``lsh`` is approximate and
    taken only when named; unless ``lsh_tables`` is set, there are so many tables that
    a pair at the similarity floor is compared with probability ``lsh_recall``. ``probed``
    is approximate as well: it looks into as many cells of stored vectors as ``probes``
    says, or as many as find a share of ``probe_recall`` of the true neighbours. The exact
    search goes by cells too where the company side has over ``dense_numbers`` numbers.

    ``keep_input_columns`` returns all columns of the narration table with the results.
    """

    company_column: tuple[str, ...] = ()
    narration_column: tuple[str, ...] = ()
    enable_transaction_filtering: bool = True
    enable_automated_city_detection: bool = True
    keep_long_alpha_words: bool = False
    max_candidates: int = 10
    similarity_floor: float = 0.3
    high_similarity: float = 80.0
    medium_similarity: float = 60.0
    search: str = "auto"
    lsh_recall: float = 0.9
    lsh_tables: int | None = None
    lsh_bits: int = 4
    lsh_seed: int = 42
    probe_recall: float = 0.9
    probes: int | None = None
    dense_numbers: int = 8_000_000
    index_postings: int = 4_000_000
    confidence_threshold: float | None = None
    drop_below_threshold: bool = False
    sort_by_score: bool = True
    keep_input_columns: bool = False
    output_columns: Mapping[str, bool] = field(default_factory=dict)

    def shows(self, column: str) -> bool:
        return self.output_columns.get(column, True)
