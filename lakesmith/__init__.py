"""lakesmith: rule-driven Bronze -> Silver -> Gold analytics on Spark.

Raw tables are profiled, turned into editable mapping-rule tables, executed
as DataFrame plans layer by layer, and queried with plain business
questions.  Every data-sized step is a Spark job; the driver only sees rule
tables, schemas and single-row statistics.
"""

from lakesmith.session import ensure_checkpoint_dir, get_session

__all__ = ["ensure_checkpoint_dir", "get_session"]
