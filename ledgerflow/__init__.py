"""ledgerflow: catalogue, price-history and activity analytics as plain Spark DataFrame functions.

Layout
------
functions/   column expressions (calendar rules, money, labels, JSON payload fields)
operators/   DataFrame -> DataFrame verbs (flatten, SCD2, bridges, facts, worklists, responses)
sources/     landing-file readers/writers and table helpers
streaming/   available-now file and table streams
plans/       multi-step jobs: SCD2 publish protocol, the daily/activity runs, registered queries
"""

from ledgerflow.session import local_session, work_dir  # noqa: F401
