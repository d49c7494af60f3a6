"""Parameters of the registered queries (shared by the Spark plans and the
SQL oracle)."""

# The listing selected on the dashboard; it exists at every supplied scale.
SELECTED_ADDRESS = "1 FURNITURE, NATION_24"
# Search box text.
SEARCH_TERM = "nation_1"
# "Today" for days on market, fixed so results are reproducible.
AS_OF = "2024-01-01"
# Churn draws: delete with seed 88, re-price with seed 89, 2 % each.
DELETE_SEED = 88
UPDATE_SEED = 89
PCT = "0.02"
# Price of the unknown id added to the upsert delta.
UNKNOWN_PRICE = "250000.00"
# Listings dated before this day form the current table of the insert
# queries; the later ones arrive as one batch (together: the whole table).
BATCH_SINCE = "1999-01-01"
