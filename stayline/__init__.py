"""Subscription-retention analytics as plain DataFrame-to-DataFrame functions."""
