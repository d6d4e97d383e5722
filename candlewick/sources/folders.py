"""Folders of any file system that Spark reaches: listing, moving, and replacing one without losing it."""

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _opened(spark, path)
    return system.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    system, place = _opened(spark, path)
    system.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; its new parent is made if need be."""
    system, place = _opened(spark, source)
    goal = _opened(spark, target)[1]
    system.mkdirs(goal.getParent())
    if not system.rename(place, goal):
        raise OSError(f"{source} can't be moved to {target}")


def make(spark: SparkSession, path: str) -> None:
    system, place = _opened(spark, path)
    system.mkdirs(place)


def mark(spark: SparkSession, path: str) -> None:
    """Make an empty file."""
    system, place = _opened(spark, path)
    system.create(place, True).close()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it does not exist."""
    system, place = _opened(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(place)) if system.exists(place) else []


def restore(spark: SparkSession, target: str) -> None:
    """Undo or finish a :func:`replace` that was cut off."""
    old = _old(target)
    if not exists(spark, old):
        return
    if exists(spark, target):
        delete(spark, old)
    else:
        move(spark, old, target)


def replace(spark: SparkSession, staged: str, target: str) -> None:
    """Put a complete folder in the place of another, which is moved aside until that is done."""
    restore(spark, target)
    if exists(spark, target):
        move(spark, target, _old(target))
    move(spark, staged, target)
    delete(spark, _old(target))


def _old(target: str) -> str:
    return f"{target.rstrip('/')}__old"
