"""Tables in versions: replacing, keeping and restoring without moving rows.

Each write of a table goes to a folder of its own and stays as it is. A version is a list of which folder
each table has; one small file names the version in force, and replacing that file is the only step that
counts. Catalog entries point to the folders and are set after it: if that is cut short, :meth:`recover`
sets them again. So several tables change together, and an earlier version comes back by its name alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from rootweave.sources.fs import Folder
from rootweave.sources.tables import drop_table

CURRENT = "_current.json"


class Versions:
    """The versioned tables of ``database``, whose folders lie below ``root``."""

    def __init__(self, spark: SparkSession, database: str, root: str):
        self.spark, self.database = spark, database
        self.folder = Folder(spark, root)
        self.folder.make()

    def current(self) -> str | None:
        """The name of the version in force."""
        return self.folder.load(CURRENT)

    def tables(self, version: str | None = None) -> dict[str, str]:
        """Folder by table of a version, by default of the one in force."""
        version = version or self.current()
        found = self.folder.load(f"{version}.json") if version else {}
        if found is None:
            raise ValueError(f"there is no version {version}")
        return found

    def replace(self, frames: Mapping[str, DataFrame]) -> str:
        """Give tables new rows, which may be computed from the old ones, all together; the name of the new version.

        Tables that are not named keep their folders.
        """
        version = uuid.uuid4().hex
        folders = self.tables()
        for table, df in frames.items():
            folders[table] = f"{self.folder.path}/{table}-{version}"
            df.write.parquet(folders[table])
        self.folder.save(f"{version}.json", folders)
        self.switch(version)
        return version

    def switch(self, version: str) -> None:
        """Bring a version into force; no row is read or written."""
        self.tables(version)
        self.folder.save(CURRENT, version)
        self.recover()

    def recover(self) -> None:
        """Point the catalog to the folders of the version in force."""
        folders = self.tables()
        for table, path in folders.items():
            name = f"{self.database}.{table}"
            if self.spark.catalog.tableExists(name):
                self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            else:
                schema = self.spark.read.parquet(path).schema
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
                self.spark.sql(f"CREATE TABLE {name} ({columns}) USING PARQUET LOCATION '{path}'")
            self.spark.catalog.refreshTable(name)
        for row in self.spark.catalog.listTables(self.database):
            if row.name not in folders and any(n.startswith(f"{row.name}-") for n in self.folder.names()):
                drop_table(self.spark, f"{self.database}.{row.name}")

    def forget(self, version: str) -> None:
        """Delete a version that is not in force, with the folders no other version has."""
        if version == self.current():
            raise ValueError(f"{version} is in force")
        gone = set(self.tables(version).values())
        self.folder.delete(f"{version}.json")
        for name in self.folder.names("*.json"):
            if name != CURRENT:
                gone -= set(self.folder.load(name).values())
        for path in gone:
            self.folder.delete(path)
