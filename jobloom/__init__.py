"""jobloom: job-listing extraction, cleaning, enrichment and delivery on Spark.

Public API (all lazy DataFrame operators unless noted):

* extraction: ``extract_jobs``, ``extract_metrics``, ``page_anchors``
* cleaning and order: ``sanitize_records``, ``dedupe_titles``, ``keep_first``,
  ``global_index``, ``batch_index``
* enrichment: ``enrich``, ``enrich_payload_rows``, ``register_sql_functions``
* validation: ``violations``, ``label_violations``, ``assert_valid`` (action), ``ValidationError``
* payloads and messages: ``pack_payloads``, ``unpack_payloads``, ``payload_row_counts``
* jobs: ``produce``, ``produce_job``, ``consume``, ``consume_job``
"""

__version__ = "0.1.0"

from jobloom.functions.scoring import register_sql_functions  # noqa: E402,F401
from jobloom.operators.dedupe import keep_first  # noqa: E402,F401
from jobloom.operators.enrich import enrich, enrich_payload_rows  # noqa: E402,F401
from jobloom.operators.extract import extract_jobs, extract_metrics, page_anchors  # noqa: E402,F401
from jobloom.operators.ordering import batch_index, global_index  # noqa: E402,F401
from jobloom.operators.sanitize import dedupe_titles, sanitize_records  # noqa: E402,F401
from jobloom.operators.validate import (  # noqa: E402,F401
    ValidationError, assert_valid, label_violations, violations)
from jobloom.plans.jobs import consume_job, produce_job  # noqa: E402,F401
from jobloom.plans.payload import pack_payloads, payload_row_counts, unpack_payloads  # noqa: E402,F401
from jobloom.plans.produce import produce  # noqa: E402,F401
from jobloom.streaming.consumer import consume  # noqa: E402,F401
