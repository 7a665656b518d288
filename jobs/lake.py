"""spark-submit --py-files podium.zip jobs/lake.py --config lake.json [--stage bronze_to_silver]"""

from __future__ import annotations

import argparse

from podium.config import LakeConfig, load
from podium.plans.lake import STAGES
from podium.session import build_session


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run the batch lake, or one stage of it.")
    parser.add_argument("--config", required=True)
    parser.add_argument("--stage", choices=["all", *STAGES], default="all")
    given = parser.parse_args(arguments)
    lake = load(LakeConfig, given.config)
    spark = build_session("podium-lake")
    for name, stage in STAGES.items():
        if given.stage in ("all", name):
            stage(spark, lake)


if __name__ == "__main__":
    main()
