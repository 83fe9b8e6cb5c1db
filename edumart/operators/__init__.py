from edumart.operators.checks import (  # noqa: F401
    count_rejects, domain_violations, duplicate_keys, long_domain_violations, require_columns)
from edumart.operators.columns import drop_like, drop_null_keys, move_first, project, rename  # noqa: F401
from edumart.operators.crosstab import (  # noqa: F401
    CodeSetError, answers_long, count_long, crosstab, crosstab_discovered, discover_codes, label_by_position, profile, rollup,
    widen)
from edumart.operators.dedupe import dedupe_first  # noqa: F401
from edumart.operators.joins import (  # noqa: F401
    chain_left, enrich, join_suffixed, null_safe_join)
from edumart.operators.ordering import desc_nulls_last_order, with_position  # noqa: F401
from edumart.operators.selection import value_stats_continuous  # noqa: F401
from edumart.operators.stats import avg_of_stats, histogram_stats, mean_of_means, mean_scores, value_stats  # noqa: F401
from edumart.operators.union import union_editions  # noqa: F401
