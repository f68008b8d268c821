"""Ready-made plans: the packs' fixed values, the build, and the driver-table queries."""
