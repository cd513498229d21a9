"""Reading and writing tables, and holding an intermediate result for the time of a job."""

from tallymark.sources.catalog import (
    add_partition,
    create_database,
    create_view,
    drop_database,
    drop_tables,
    drop_temp_views,
    drop_views,
    use_database,
)
from tallymark.sources.readers import (
    accepted_rows,
    create_delimited_table,
    read_delimited,
    read_table,
    rejected_lines,
    write_delimited,
)
from tallymark.sources.scope import cached, checkpointed, held, scratch_database, scratch_root, temp_view
from tallymark.sources.writers import (
    UnsafeInsert,
    append_by_name,
    append_or_create,
    buckets_for,
    create_empty_table,
    fit_to_table,
    replace_partition,
    replace_partitions,
    write_bucketed,
    write_partitioned,
    writing,
)

__all__ = [
    "UnsafeInsert",
    "accepted_rows",
    "add_partition",
    "append_by_name",
    "append_or_create",
    "buckets_for",
    "cached",
    "checkpointed",
    "create_database",
    "create_delimited_table",
    "create_empty_table",
    "create_view",
    "drop_database",
    "drop_tables",
    "drop_temp_views",
    "drop_views",
    "fit_to_table",
    "held",
    "read_delimited",
    "read_table",
    "rejected_lines",
    "replace_partition",
    "replace_partitions",
    "scratch_database",
    "scratch_root",
    "temp_view",
    "use_database",
    "write_bucketed",
    "write_delimited",
    "write_partitioned",
    "writing",
]
