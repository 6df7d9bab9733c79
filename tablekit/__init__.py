"""tablekit: relational table queries, mutations, constraints and schema
evolution expressed as PySpark DataFrame jobs.

The common entry points are re-exported here::

    from tablekit import upsert, update, delete_join, check, rank_within, page
"""

from tablekit.operators.batch import Batch
from tablekit.operators.evolve import (add_column, add_foreign_key, add_unique, change_column,
                                       drop_column, drop_foreign_key, modify_column, rename_table,
                                       set_default)
from tablekit.operators.ids import assign_ids
from tablekit.operators.mutate import (active, delete, delete_chunk, delete_join, drain, insert,
                                       insert_ignore, insert_select, mark_processed, purge,
                                       purge_partitions, replace, soft_delete, update, update_chunk,
                                       update_join, upsert)
from tablekit.operators.quality import (check, delete_parent, enforce, enum_ordinal, json_field,
                                        lob_class, to_utc, update_parent_key)
from tablekit.operators.query import (anti, full_join, full_via_union, join, left_join,
                                      oldest, page, page_after, right_join, semi, summarize, union)
from tablekit.operators.text import (bm25_search, build_text_index, charset_audit, collated,
                                     convert_charset, search_index, with_collation, write_text_index)
from tablekit.operators.window import rank_within, top_k
from tablekit.sources.sinks import (append, compact, create_database, create_table, publish,
                                    truncate, write_clustered)
from tablekit.sources.tables import rows, scan
from tablekit.spec import ColumnSpec, ForeignKey, TableSpec

__all__ = [name for name in dir() if not name.startswith("_")]
