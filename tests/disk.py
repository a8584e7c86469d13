"""What a session holds on disk."""

import re
import time
from pathlib import Path

from riskloom.session import scratch_root


def shuffle_ids(spark) -> set[str]:
    """Shuffles with files on this machine."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return set(re.findall(r"/shuffle_(\d+)_", disk.getAllFiles().mkString("\n")))


def scratch_folders(spark) -> set[str]:
    return {p.name for p in Path(re.sub("^file:(//)?", "", scratch_root(spark)), "riskloom").glob("*")}


def soon(is_so, seconds: float = 20) -> bool:
    """Whether it becomes so: Spark removes files in the background."""
    until = time.time() + seconds
    while not is_so() and time.time() < until:
        time.sleep(0.2)
    return is_so()
