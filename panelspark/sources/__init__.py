"""Landing readers and sinks."""

from panelspark.operators.clean import normalise_columns, project  # noqa: F401  (S10, S09)
from panelspark.plans.enrichment import explode_series, split_errors  # noqa: F401  (S07, S12)
from panelspark.sources.landing import (json_rows_to_df, load_or_skip, materialise,  # noqa: F401
                                        read_bulk, read_json_pages, read_table, read_years,
                                        read_zipped_csv, stage_root, write_table)
