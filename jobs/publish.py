"""spark-submit --py-files podium.zip jobs/publish.py --config publish.json"""

from __future__ import annotations

import argparse

from podium.config import PublishConfig, load
from podium.plans import publish_facts
from podium.session import build_session


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Publish a database table as JSON messages.")
    parser.add_argument("--config", required=True)
    publish = load(PublishConfig, parser.parse_args(arguments).config)
    publish_facts(build_session("podium-publish"), publish)


if __name__ == "__main__":
    main()
