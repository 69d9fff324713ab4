"""The registered queries and their SQL."""

from . import flows as flows
