r"""Refresh one gold table from the command line, for spark-submit.

    spark-submit --py-files tripgrain.zip refresh_job.py \
        --grain hour --source <positions> --target <gold> --table <catalog table> \
        [--load-type FULL_LOAD | INCREMENTAL] [--stop-speed 5] [--harsh 10] \
        [--repair-from 2024-01-05T00:00]
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from tripgrain import GRAINS, refresh
from tripgrain.functions.motion import HARSH_CHANGE, STOP_SPEED
from tripgrain.operators.trips import Motion
from tripgrain.sources.positions import read_positions


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--grain", choices=GRAINS, required=True)
    for name in ("--source", "--target", "--table"):
        parser.add_argument(name, required=True)
    parser.add_argument("--load-type", default="INCREMENTAL")
    parser.add_argument("--stop-speed", type=float, default=STOP_SPEED)
    parser.add_argument("--harsh", type=float, default=HARSH_CHANGE)
    parser.add_argument("--repair-from", type=datetime.fromisoformat)
    chosen = parser.parse_args(arguments)

    spark = SparkSession.builder.appName(f"{chosen.grain} driving statistics").getOrCreate()
    grain = GRAINS[chosen.grain]
    ran = refresh(
        read_positions(spark, chosen.source, grain),
        grain,
        chosen.target,
        chosen.table,
        chosen.load_type,
        formulas=Motion(stop_speed=chosen.stop_speed, harsh=chosen.harsh),
        repair_from=chosen.repair_from,
    )
    print(f"{chosen.table}: {ran or 'nothing new'}")


if __name__ == "__main__":
    main()
