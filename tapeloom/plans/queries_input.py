"""The derived input tables themselves, checked like any query."""

from tapeloom.plans import fixtures as fx
from tapeloom.plans.registry import query

query("input_bars", "fixture", "SELECT * FROM bars", "open high low close")(fx.bars)
query("input_bars_dirty", "fixture", "SELECT * FROM bars_dirty", "open high low close")(fx.bars_dirty)
query("input_econ", "fixture", "SELECT * FROM econ", "value")(fx.econ)
query("input_metadata", "fixture", "SELECT * FROM metadata", "market_cap")(fx.metadata)
query("input_news", "fixture", "SELECT * FROM news", "sentiment_score")(fx.news)
query("input_ticks", "fixture", "SELECT * FROM ticks", "price")(fx.ticks)
