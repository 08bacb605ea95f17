"""The fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterism.functions.keys import add_ordered_key, add_surrogate_key
from asterism.operators.layout import rebalance
from asterism.operators.lookup import BROADCAST_LIMIT, MOST_TASKS, JoinFigures, lookup_join
from asterism.operators.transforms import distinct_rows, project

# Fact column -> column of the play or of the matched song.
PLAY_FIELDS = {
    "start_time": "start_time",
    "user_id": "userId",
    "level": "level",
    "song_id": "song_id",
    "artist_id": "artist_id",
    "session_id": "sessionId",
    "location": "location",
    "user_agent": "userAgent",
}
SONG_SIDE = ("song_id", "artist_id")
# by time first, then by every other column, so that only equal rows are ties
ORDER = tuple(PLAY_FIELDS)
TITLE_ONLY = (("song", "title"),)


def build_songplays(
    plays: DataFrame,
    songs: DataFrame,
    on: Sequence[tuple[str, str]] = TITLE_ONLY,
    dedup_before_id: bool = False,
    broadcast_limit: int = BROADCAST_LIMIT,
    min_tasks: int | None = None,
    compact: bool = False,
    ordered_key: bool = False,
    most_tasks: int = MOST_TASKS,
    figures: JoinFigures | None = None,
) -> DataFrame:
    """One row per play and matching song, with a surrogate key and month keys.

    Plays without a match are dropped, and songs sharing a title each give a row.
    ``on`` may add further ``(play column, song column)`` pairs. No distinct
    follows the key, as a unique key leaves nothing to remove;
    ``dedup_before_id`` removes repeated rows while they can still be told apart
    from distinct ones: of the plays and of the songs before they multiply each other,
    which costs a shuffle of the plays, and of the matched rows. ``compact`` gathers
    each month for the write, before the key is added. With ``ordered_key`` the keys
    are 1, 2, 3 ... in the order of ORDER, the same in every run; the rows are then
    laid out by time, so that needs no gathering. ``figures`` learns how many plays match
    no song (of the distinct ones, where repeated rows are removed first).
    """
    song_columns = dict.fromkeys([*(right for _, right in on), *SONG_SIDE])
    play_columns = dict.fromkeys(
        [*(left for left, _ in on), *(source for source in PLAY_FIELDS.values() if source not in SONG_SIDE)]
    )
    plays, songs = plays.select(*play_columns), songs.select(*song_columns)
    if dedup_before_id:
        plays, songs = distinct_rows(plays), distinct_rows(songs)
    matched = lookup_join(plays, songs, on, broadcast_limit, min_tasks, most_tasks, figures)
    rows = project(matched, PLAY_FIELDS)
    if dedup_before_id:
        rows = distinct_rows(rows)
    keys = {"year_partition": F.year("start_time"), "month_partition": F.month("start_time")}
    rows = rows.withColumns(keys)
    if ordered_key:
        return add_ordered_key(rows, "songplay_id", F.lit(0), ORDER)
    if compact:
        rows = rebalance(rows, [*keys])
    return add_surrogate_key(rows, "songplay_id")
