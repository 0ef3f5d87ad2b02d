"""ledgerline: a Spark-native commerce analytics warehouse.

Raw customer / product / order tables become cleaned staging views, a
customer dimension with RFM segments and churn flags, an order-level
sales fact, a daily sales summary with trend windows, retention cohorts,
an incrementally loaded order fact, SCD2 customer history and data
quality gates -- all as DataFrame plans over built-in functions.
"""

__version__ = "0.1.0"
