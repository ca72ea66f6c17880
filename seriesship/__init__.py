"""Metric shipping on Spark: flatten, label, relabel, batch, encode, queue and deliver."""

import sys

from pyspark import cloudpickle

from seriesship.config import ClientConfig, PushConfig, RetryPolicy
from seriesship.operators.batching import assign_batches, batch_stats
from seriesship.operators.encode import decode_payloads, encode_batches
from seriesship.operators.flatten import flatten
from seriesship.operators.relabel import Rule, relabel
from seriesship.plans.push import push, push_batches, push_series

# Task functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "ClientConfig",
    "PushConfig",
    "RetryPolicy",
    "Rule",
    "assign_batches",
    "batch_stats",
    "decode_payloads",
    "encode_batches",
    "flatten",
    "push",
    "push_batches",
    "push_series",
    "relabel",
]
