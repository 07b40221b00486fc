from linkcohort.operators.checks import missingness, tabulate, uniqueness, violating, violations
from linkcohort.operators.codes import SEPARATOR, any_code, any_codes, match_codes, melt_codes, pack_codes, prefixes, unpack_codes
from linkcohort.operators.compare import agreement, concordance, linkage_bias, standardised_differences
from linkcohort.operators.link import (
    add_new_members, attach, eligibility, exists_summary, fill_from, flag_by_lookup,
    flag_exists, flags_by_group, link, linkage_report, restrict_to,
)
from linkcohort.operators.panel import (
    annualise, around_event, collapse_sum, rate, rates, school_year_panel,
    with_year7, within_school_window, within_window,
)
from linkcohort.operators.reduce import (
    any_in_group, dense_rank_in, ever, first_clear_event, first_date, first_per, highest, latest, modal,
    number_rows, pooled_modal, resolve, run_id, weighted_modal,
)
from linkcohort.operators.reshape import dcast, melt
from linkcohort.operators.spells import collapse_intervals, join_spells, los_nights, repair_dates, spell_bounds
from linkcohort.operators.state import bound_state, count_state, merge_bounds, merge_counts, modes_of

__all__ = [
    "SEPARATOR", "add_new_members", "agreement", "annualise", "any_code", "any_codes", "any_in_group", "around_event", "attach",
    "bound_state", "collapse_intervals", "collapse_sum", "concordance", "count_state", "dcast", "dense_rank_in", "eligibility", "ever", "exists_summary",
    "fill_from", "first_clear_event", "first_date", "first_per", "flag_by_lookup", "flag_exists", "flags_by_group",
    "highest", "join_spells", "latest", "link", "linkage_bias", "linkage_report", "los_nights",
    "match_codes", "melt", "melt_codes", "merge_bounds", "merge_counts", "missingness", "modal", "modes_of", "number_rows", "pack_codes", "pooled_modal", "prefixes",
    "rate", "rates", "repair_dates", "resolve", "restrict_to", "run_id", "school_year_panel",
    "spell_bounds", "standardised_differences", "tabulate", "uniqueness", "unpack_codes", "violating", "violations", "with_year7",
    "weighted_modal", "within_school_window", "within_window",
]
