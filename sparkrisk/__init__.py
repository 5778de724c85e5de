"""sparkrisk: event-history risk analytics on Spark DataFrames, SQL and MLlib.

The main operators, importable from the package root (no session is needed to import):

    from sparkrisk import build_history, latest_features, train_risk, predict_risk
"""

from sparkrisk.ml.evaluate import accuracy, auc, hash_split, roc_curve
from sparkrisk.ml.model import predict_risk, risk_pipeline, train_risk
from sparkrisk.operators.clean import clean_city, clean_events
from sparkrisk.operators.history import build_history, latest_features, latest_state, pivot_count
from sparkrisk.operators.profile import corr_matrix, describe_all, profile, value_counts
from sparkrisk.operators.sequence import latest, ordered_window
from sparkrisk.operators.text import decode, encode, ngrams, pad, tokens, vocabulary
from sparkrisk.session import local_session, materialize, prepare, stage_scope
from sparkrisk.sources.pages import conform, ingest, page_plan, read_pages
from sparkrisk.streaming.ingest import ingest_stream

__version__ = "0.1.0"

__all__ = [
    "accuracy", "auc", "build_history", "clean_city", "clean_events", "conform", "corr_matrix", "decode",
    "describe_all", "encode", "hash_split", "ingest", "ingest_stream", "latest", "latest_features", "latest_state",
    "local_session", "materialize", "ngrams", "ordered_window", "pad", "page_plan", "pivot_count",
    "predict_risk", "prepare", "profile", "read_pages", "risk_pipeline", "roc_curve", "stage_scope",
    "tokens", "train_risk", "value_counts", "vocabulary",
]
