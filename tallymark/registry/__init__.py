"""Every analysis under its name, over the driver tables, with its SQL counterpart."""
