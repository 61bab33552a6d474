"""Binary captures and sockets as event tables."""
