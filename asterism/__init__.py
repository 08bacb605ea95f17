"""Star schemas from event logs, as plain DataFrame functions."""

from asterism.plans.jobs import expire_star, load_star, preview, run_catalogue, run_log, run_star
from asterism.session import create_session, object_store_conf
from asterism.sources.schemas import SONG_KEYS_YEAR_ARTIST, SONG_KEYS_YEAR_BUCKET, SONG_KEYS_YEAR_TWICE

__all__ = [
    "SONG_KEYS_YEAR_ARTIST",
    "SONG_KEYS_YEAR_BUCKET",
    "SONG_KEYS_YEAR_TWICE",
    "create_session",
    "expire_star",
    "load_star",
    "object_store_conf",
    "preview",
    "run_catalogue",
    "run_log",
    "run_star",
]
