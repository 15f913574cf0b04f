"""Fixed values and default parameters.

Fixed values (must equal the event simulator's domains so decoded events and
fixture views carry the same labels):

- currencies, in order: USD, EUR, GBP, JPY, INR
- product categories, in order: electronics, clothing, books, home, sports, toys
- countries, in order: US, UK, DE, FR, JP, IN, BR, CA
- devices, in order: mobile, desktop, tablet
- user event types: LOGIN, LOGOUT, SIGNUP; view events: VIEW; orders: ORDER
- spend segments: VIP above 1000, Premium above 500, Regular above 100, else New
- order-count buckets: "1 order", "2-5 orders", "6-10 orders", "10+ orders"
"""

from __future__ import annotations

import datetime as _dt

# ---- fixed values ---------------------------------------------------------
CURRENCIES = ["USD", "EUR", "GBP", "JPY", "INR"]
CATEGORIES = ["electronics", "clothing", "books", "home", "sports", "toys"]
COUNTRIES = ["US", "UK", "DE", "FR", "JP", "IN", "BR", "CA"]
DEVICES = ["mobile", "desktop", "tablet"]
USER_EVENT_TYPES = ["LOGIN", "LOGOUT", "SIGNUP"]

# (label, exclusive lower bound on total spend), checked top-down
SEGMENTS = [("VIP", 1000.0), ("Premium", 500.0), ("Regular", 100.0)]
SEGMENT_DEFAULT = "New"

# (label, low, high) inclusive count ranges; anything else is the last label
ORDER_BUCKETS = [("1 order", 1, 1), ("2-5 orders", 2, 5), ("6-10 orders", 6, 10)]
ORDER_BUCKET_REST = "10+ orders"

# ---- streaming defaults -----------------------------------------------------
WATERMARK = "10 minutes"
REVENUE_WINDOW = "5 minutes"
FUNNEL_WINDOW = "5 minutes"
SESSION_WINDOW = "5 minutes"
BASKET_WINDOW = "1 hour"
BASKET_SLIDE = "30 minutes"
TRIGGER = "10 seconds"
RECOMMENDATION_TRIGGER = "60 seconds"
# sink tables: folders of one level that are folded into one of the next, and
# how long a folder stays after it has left the table's newest version
FOLD_FAN = 8
RETAIN_SECONDS = 86_400.0

# replays: least number of state partitions, and the rows of the first one (their
# number grows with the square root of the feed, see streaming.replay)
STATE_PARTITIONS = 16
STATE_ROWS = 10_000

# Fixed evaluation instant for "NOW()" lookbacks on the fixture tables.
AS_OF = _dt.datetime(2024, 1, 31, 0, 0, 0)
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"

# Pair generation: every basket is dealt into blocks of about this many distinct
# items, and each pair of blocks is one join key (see operators.baskets).
PAIR_BLOCK_ITEMS = 512

# Top pairs: items of one block of like norms, and pairs that one task sums.
TOP_BLOCK_ITEMS = 2000
TOP_TASK_PAIRS = 2_000_000
