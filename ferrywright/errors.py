"""Outcome classes. ``exit_code`` is what a command-line wrapper should return."""


class MigrationError(Exception):
    exit_code = -999


class InvalidInputError(MigrationError, ValueError):
    exit_code = -1


class DuplicateTargetError(MigrationError):
    exit_code = -2


class CapabilityError(MigrationError):
    """A file system lacks ACLs (exit code -3) or extended attributes (-4)."""

    def __init__(self, message: str, feature: str = "acl"):
        super().__init__(message)
        self.exit_code = {"acl": -3, "xattr": -4}[feature]


class CopyFailedError(MigrationError):
    """A copy job produced failures that the failure policy does not ignore."""
