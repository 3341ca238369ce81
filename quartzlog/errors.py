"""One exception class per condition a caller can tell apart."""


class TableLogError(Exception):
    """Base of all errors of this package."""


class IllegalArgument(TableLogError, ValueError):
    """An argument outside its domain."""


class IllegalState(TableLogError):
    """The log or the transaction does not allow the call."""


class FileNotFound(TableLogError):
    """A log file that was asked for is absent."""


class CommitFileExists(TableLogError):
    """Another writer has this version."""


class VersionNotFound(TableLogError):
    def __init__(self, version, earliest, latest):
        super().__init__(f"version {version} is not available: versions {earliest} to {latest} are")
        self.version, self.earliest, self.latest = version, earliest, latest


class TimestampTooEarly(TableLogError):
    """The timestamp is before the first commit that can be read."""


class TimestampTooLate(TableLogError):
    """The timestamp is after the last commit."""


class ActionNotFound(IllegalState):
    def __init__(self, action, version):
        super().__init__(f"the state at version {version} lacks its {action} action")
        self.action, self.version = action, version


class VersionsNotContiguous(IllegalState):
    def __init__(self, versions):
        super().__init__(f"versions are not contiguous: {versions}")


class MissingCheckpointPart(IllegalState):
    """A checkpoint that is referred to lacks a part."""


class NoReproducibleHistory(TableLogError):
    """No version can be rebuilt from the files left."""


class NoHistory(TableLogError):
    """There is no commit."""


class InvalidProtocol(TableLogError):
    """The table needs a newer reader or writer."""


class MetadataAbsent(IllegalState):
    """The first commit of a table has no metadata."""


class PartitioningMismatch(IllegalState):
    """A file's partition keys are not the table's."""


class AppendOnlyViolation(TableLogError):
    """A removal of data from an append-only table."""


class SchemaChange(IllegalState):
    """The new schema cannot read the data of the old one."""


class NonPartitionColumnAbsent(TableLogError):
    """All columns are partition columns."""


class PartitionColumnsNotFound(TableLogError):
    """A partition column is not in the schema."""


class InvalidColumnName(TableLogError):
    """A column name holds a character that files cannot hold."""


class InvalidPartitionColumn(InvalidColumnName):
    """A partition column's name holds such a character."""


class DuplicateColumns(TableLogError):
    """Two columns have the same name, letter case aside."""


class NestedNotNull(TableLogError):
    """NOT NULL inside an array or a map."""


class FieldTypeMismatch(TableLogError):
    """A field is used with another type than it has."""


class UnknownColumn(TableLogError):
    """A name that the schema does not have."""


class ConcurrentModification(TableLogError):
    """Base of all conflicts between transactions."""


class ConcurrentAppend(ConcurrentModification):
    """Another transaction added files that this one's reads would have seen."""


class ConcurrentDeleteRead(ConcurrentModification):
    """Another transaction removed files that this one read."""


class ConcurrentDeleteDelete(ConcurrentModification):
    """Another transaction removed files that this one removes."""


class MetadataChanged(ConcurrentModification):
    """Another transaction changed the metadata."""


class ProtocolChanged(ConcurrentModification):
    """Another transaction changed the protocol."""


class ConcurrentTransaction(ConcurrentModification):
    """Another transaction has the same application id."""
