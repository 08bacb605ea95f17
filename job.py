"""Command line of the jobs, for ``spark-submit`` or plain Python.

    job.py build INPUT_ROOT OUTPUT_ROOT [--song-folders year|artist|bucket] ...
    job.py preview OUTPUT_ROOT [--rows 10]
    job.py expire OUTPUT_ROOT [--keep 1]
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from asterism import (
    SONG_KEYS_YEAR_ARTIST,
    SONG_KEYS_YEAR_BUCKET,
    SONG_KEYS_YEAR_TWICE,
    create_session,
    expire_star,
    load_star,
    object_store_conf,
    preview,
    run_star,
)
from asterism.session import COMMITTERS
from asterism.sources.schemas import PLAY_PAGE

SONG_FOLDERS = {"year": SONG_KEYS_YEAR_TWICE, "artist": SONG_KEYS_YEAR_ARTIST, "bucket": SONG_KEYS_YEAR_BUCKET}
# what a line needs to be of use
REQUIRED = {"required_song": ["song_id"], "required_log": ["userId", "ts"]}


def parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--song-folders", choices=SONG_FOLDERS, default="year")
    common.add_argument("--s3a-connector", help="Maven coordinate of the Hadoop S3A module")
    common.add_argument("--s3a-credentials", help="class name of the S3A credentials provider")
    common.add_argument("--s3a-cloud-module", help="Maven coordinate of spark-hadoop-cloud: commit writes without renames")
    common.add_argument("--s3a-committer", choices=COMMITTERS, default="magic")
    top = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = top.add_subparsers(dest="command", required=True)
    build = commands.add_parser("build", parents=[common], help="input trees to the stored star schema")
    build.add_argument("input_root")
    build.add_argument("output_root")
    build.add_argument("--page", default=PLAY_PAGE, help="log event that counts as a play")
    build.add_argument("--dedup-before-id", action="store_true", help="drop repeated fact rows")
    build.add_argument("--drop-null-keys", action="store_true", help="drop lines without song_id, userId or ts")
    build.add_argument("--ordered-key", action="store_true", help="number the fact in a fixed order")
    build.add_argument("--bad-lines", action="store_true", help="keep lines that can't be read in tables of their own")
    build.add_argument("--resume", action="store_true", help="leave tables that an earlier run with --resume made from the same input")
    build.add_argument("--by-id", action="store_true", help="lay artists and users out for look-ups by id")
    show = commands.add_parser("preview", parents=[common], help="a few rows of each stored table")
    show.add_argument("output_root")
    show.add_argument("--rows", type=int, default=10)
    expire = commands.add_parser("expire", parents=[common], help="free what earlier versions of the tables take")
    expire.add_argument("output_root")
    expire.add_argument("--keep", type=int, default=1, help="versions that stay")
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    conf = {}
    if args.s3a_connector or args.s3a_credentials:
        if not (args.s3a_connector and args.s3a_credentials):
            raise SystemExit("--s3a-connector and --s3a-credentials belong together")
        conf = object_store_conf(args.s3a_connector, args.s3a_credentials, args.s3a_cloud_module, args.s3a_committer)
    elif args.s3a_cloud_module:
        raise SystemExit("--s3a-cloud-module needs --s3a-connector and --s3a-credentials")
    spark = create_session(conf=conf)
    song_keys = SONG_FOLDERS[args.song_folders]
    if args.command == "build":
        options = {"page": args.page, "dedup_before_id": args.dedup_before_id, "ordered_key": args.ordered_key, "bad_lines": args.bad_lines, "resume": args.resume, "by_id": args.by_id}
        if args.drop_null_keys:
            options |= REQUIRED
        print(json.dumps(run_star(spark, args.input_root, args.output_root, song_keys, **options)))
    elif args.command == "expire":
        expire_star(spark, args.output_root, song_keys, args.keep)
    else:
        for name, df in load_star(spark, args.output_root, song_keys).items():
            print(name)
            preview(df, args.rows).show(args.rows)


if __name__ == "__main__":
    main()
