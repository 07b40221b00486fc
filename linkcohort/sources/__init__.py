from linkcohort.sources.catalog import Tables, discover, open_table, table_names
from linkcohort.sources.files import (
    checked_root, codelist, in_shared_dir, load_step, normalise_codelist, read_codelist,
    read_csv_module, save_step, shared_dir, write_table,
)
from linkcohort.sources.harmonise import (
    census_term, census_year, find_column, harmonise, lower_names, numbered,
    union_all, union_family, year_group,
)
from linkcohort.sources.marks import (
    Mark, content_key, key_of, load_bucketed, read_marks, save_bucketed, schema_from, write_mark,
)

__all__ = [
    "Mark", "Tables", "checked_root", "census_term", "census_year", "codelist", "content_key", "discover",
    "find_column", "harmonise", "in_shared_dir", "key_of", "load_bucketed", "load_step", "lower_names", "normalise_codelist", "numbered",
    "open_table", "read_codelist", "read_csv_module", "read_marks", "save_bucketed", "save_step", "schema_from", "shared_dir", "table_names",
    "union_all", "union_family", "write_mark", "write_table", "year_group",
]
