"""docroute: routing documents through a processing pipeline, on Spark."""

from docroute.operators.engine import Engine, select_sends
from docroute.operators.rules import Rule, Stage, default_rules
from docroute.plans.reports import routing_summary
from docroute.plans.supervise import supervise
from docroute.plans.supervise_log import supervise_log
from docroute.sources.messages import decode_messages, read_messages
from docroute.sources.rules import Required, RulesTable
from docroute.streaming.supervise_stream import supervise_stream

__all__ = [
    "Engine",
    "Required",
    "Rule",
    "RulesTable",
    "Stage",
    "decode_messages",
    "default_rules",
    "read_messages",
    "routing_summary",
    "select_sends",
    "supervise",
    "supervise_log",
    "supervise_stream",
]
