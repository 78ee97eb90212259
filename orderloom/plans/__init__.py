"""Whole jobs: conforming each source, history, invoices, control state, rebuilds.

Every plan takes a list of months (None: all of them) and carries the month as a key
through its joins, windows and groups, so one job gives what a run per month would.
"""
