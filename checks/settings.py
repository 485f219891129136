"""Settings of the registered queries."""

import os

# Rows per bucket of ranked groups, for checks and benchmark alike. Small, so that the test tables take the
# bucketed path that large tables take with the library's own default.
ROWS_PER_BUCKET = int(os.environ.get("CHECK_ROWS_PER_BUCKET", 2_000))
